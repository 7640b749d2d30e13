"""DataFrame-to-DataFrame operators over change logs."""
