"""A relational domain described once and queried with lambdas, compiled to Spark plans."""
