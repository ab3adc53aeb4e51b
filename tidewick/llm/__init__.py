"""Training-data operators: ten operators on documents, vectors and pages, their queries in ``queries``."""
