"""Training-data operators: one module an operator, registered in ``queries``."""
