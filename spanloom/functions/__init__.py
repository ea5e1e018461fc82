"""Column functions and distribution tails."""
