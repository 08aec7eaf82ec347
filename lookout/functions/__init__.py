"""Column functions: names, boxes and label texts.  All are built-in expressions, so they stay in generated code."""
