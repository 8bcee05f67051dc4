"""DataFrame operators: joins, groups, facts, periods, Pareto, recency, budgets."""
