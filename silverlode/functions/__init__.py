"""Column helpers and the scale-aware building blocks the operators share."""
