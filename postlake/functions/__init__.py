"""See README.md for what is where."""
