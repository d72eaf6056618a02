"""Scalar column functions."""
from marketpulse.functions.labels import *  # noqa: F401,F403
