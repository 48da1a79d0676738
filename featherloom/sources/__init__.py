"""Reading and writing tables, predictions and parameters."""
