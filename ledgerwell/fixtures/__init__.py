"""Test inputs: the driver's tables put into statement shape. All names are invented."""
