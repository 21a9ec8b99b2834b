"""Training-data operators (one module each). Nothing else in the library imports this subpackage."""
