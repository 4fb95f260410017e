"""Plan assembly: the pipeline graph, the query registry and the SQL oracle."""
