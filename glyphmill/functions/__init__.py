"""Part of the text-encoding engine."""
