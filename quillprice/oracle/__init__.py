"""Independent DuckDB SQL for every registered query (the correctness oracle).

The testdata tables are views named after their files; fixtures are repeated
as CTEs (``quillprice.sources.fixtures.fixture_cte``).
"""

from __future__ import annotations

from quillprice.sources.fixtures import fixture_cte


def compose(fixtures: tuple[str, ...] | list[str], ctes: list[str], select: str) -> str:
    head = fixture_cte(*fixtures)
    body = ",\n".join([head[len("WITH "):]] + list(ctes)) if ctes else head[len("WITH "):]
    return f"WITH {body}\n{select}"
