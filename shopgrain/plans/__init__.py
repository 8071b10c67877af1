"""Views over the test tables, the query registry and the matching SQL."""
