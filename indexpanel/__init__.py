"""Index-series and panel analytics as plain DataFrame -> DataFrame functions."""
