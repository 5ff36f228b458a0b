"""A helper module that jobs ship to their executors; it imports
nothing of this library."""


def digit_sum(text):
    """Sum of the decimal digits of a text; 0 for none."""
    return sum(int(c) for c in text or "" if c in "0123456789")
