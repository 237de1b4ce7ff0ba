"""Set-oriented operators on cube, frame and sample tables."""
