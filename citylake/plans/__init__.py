"""Plans: the marts, dashboard queries, feature table and model built from the operators."""
