"""Composite jobs built from the operators (mix preparation, calibration, evaluation...)."""
