"""Search for keys anywhere in JSON documents."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _search(node: object, keys: tuple[str, ...], out: list[str]) -> None:
    if isinstance(node, list):
        for x in node:
            _search(x, keys, out)
    elif isinstance(node, dict):
        for k, v in node.items():
            if not any(t in k.lower() for t in keys):
                _search(v, keys, out)
                continue
            for x in v if isinstance(v, list) else [v]:
                if isinstance(x, str) and x.strip():
                    out.append(x.strip())
                elif isinstance(x, (int, float)):
                    out.append(str(x))
                elif isinstance(x, dict) and isinstance(v, list):  # an object right under a matching key isn't entered
                    _search(x, keys, out)


def values_by_key(doc: Column, keys: tuple[str, ...]) -> Column:
    """Sorted distinct values under keys whose lower-case name contains one of `keys`; unreadable documents give none."""

    @F.pandas_udf("array<string>")
    def run(docs: pd.Series) -> pd.Series:
        def one(d: str | None) -> list[str]:
            try:
                out: list[str] = []
                _search(json.loads(d or "null"), keys, out)
                return sorted(set(out))
            except ValueError:
                return []

        return docs.map(one)

    return run(doc)
