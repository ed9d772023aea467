"""Jobs that run as streams."""
