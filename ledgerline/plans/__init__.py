"""Parameters, dimension tables and the settlement plan built from the operators."""
