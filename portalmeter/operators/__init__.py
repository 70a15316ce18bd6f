"""Hit counting, identity resolution and the monthly fact tables."""
