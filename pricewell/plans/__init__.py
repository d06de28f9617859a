"""Plans: one load run as a DataFrame transformation, BI views and queries, the load job."""
