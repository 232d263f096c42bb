"""The dimension, fact and load jobs, composed from the operators."""
