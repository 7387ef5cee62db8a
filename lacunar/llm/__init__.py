"""Training-data operators for very large corpora. Nothing outside this subpackage imports it."""
