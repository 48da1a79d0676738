"""Estimator factory, out-of-fold fitting, search and stacking on MLlib."""
