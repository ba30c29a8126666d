"""Sources: landing CSV (batch and stream), rule documents, object files."""
