"""Table writers and the staging area."""
