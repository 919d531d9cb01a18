"""Operators of a training-data pipeline: thirteen corpus operators, each usable
alone, and one query per operator (``registry``).  Nothing else in the
library imports this package."""
