"""DataFrame -> DataFrame operators over change logs."""
