"""Jobs composed of operators, and the versioned store they write to."""
