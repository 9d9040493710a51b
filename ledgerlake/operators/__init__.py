"""Row-level operators, each a function from DataFrame(s) to a DataFrame."""
