"""Stock transfers between the stores of a retail chain, as Spark jobs."""
