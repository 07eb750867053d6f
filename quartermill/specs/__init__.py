"""Field, tax and rule specifications: fixed values and the jobs that compile them."""
