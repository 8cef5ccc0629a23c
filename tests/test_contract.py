"""Driver contract: registry shape, documentation, stable entry schema."""

import inspect
import re

import __spark_entry__ as E
from tidewatch.plans import catalogue

ID = re.compile(r"\b(S|K|P|F|J|A|W|O|U|M|X|FX|ML|ST)\d{1,2}\b")


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_every_query_names_the_operators_it_covers():
    missing = [n for n, fn in catalogue.QUERIES.items() if not ID.search(inspect.getdoc(fn) or "")]
    assert missing == []


def test_entry_schema(spark):
    df = E.entry(spark)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        ("rank", "int"), ("outcome", "string"), ("n", "bigint"), ("pct", "double")]
