"""Plans: the layered table builds (bronze / silver / gold) and the registered
queries that exercise every operator on the driver's tables."""
