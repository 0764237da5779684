from checks.queries import (  # noqa: F401
    aggregates, charts, evaluation, features, forecasting, joins, lines, quality, scalars, sources, windows,
)
