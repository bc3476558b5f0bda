"""Training-data operators.  Nothing else in the library imports this
subpackage; ``queries`` registers its queries and their SQL."""
