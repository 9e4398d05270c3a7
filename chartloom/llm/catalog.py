"""The queries of this subpackage, gathered for `__spark_entry__`."""

from chartloom.registered.catalog import portable

QUERIES: dict = {}
EXPECTED: dict[str, str] = {}


def query(name: str, expected: str | None = None, exact: bool = False):
    """Register a query of this subpackage and, where SQL can state it, its expected result.

    `exact` results keep their types and every digit.
    """
    def register(run):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run if exact else lambda spark, folder: portable(run(spark, folder))
        if expected is not None:
            EXPECTED[name] = expected
        return run

    return register
