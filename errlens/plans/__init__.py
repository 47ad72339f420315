"""Query plans over the driver's tables: fixtures, registered queries, oracle SQL."""
