"""DataFrame operators: joins, running sums, conversion paths, grouping sets."""
