"""Operators for training data and entity texts. Nothing else in the package imports this one."""
