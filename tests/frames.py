"""Hand-made frames: null keys, ties in time, one-row groups, a key that owns a third of the rows."""

from __future__ import annotations

import random

import pandas as pd

SCHEMA = ("TransactionID long, isFraud int, TransactionDT long, TransactionAmt double, ProductCD string, card1 int, "
          "card2 double, P_emaildomain string, R_emaildomain string, addr1 double, DeviceInfo string")


def random_rows(n: int = 400, seed: int = 1) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        card = 7 if rng.random() < 0.34 else rng.randint(100, 130)
        if i == 5:
            card = 999  # a group of one row
        second = rng.choice([0, 3600, 86400, 86400 * 3]) if rng.random() < 0.2 else rng.randint(0, 86400 * 12)
        rows.append((
            i * 3 + 1, int(rng.random() < 0.2), second, round(rng.random() * 600, 2), rng.choice("WHCRS"),
            None if rng.random() < 0.1 else card, None if rng.random() < 0.2 else float(rng.randint(1, 4)),
            rng.choice(["gmail.com", "gmail.com", "yahoo.com", None]), rng.choice(["aol.com", None]),
            None if rng.random() < 0.1 else float(rng.randint(1, 5)), rng.choice(["Windows", "SM-A", None, None])))
    rng.shuffle(rows)
    return rows


def frame(spark, rows=None):
    return spark.createDataFrame(rows if rows is not None else random_rows(), SCHEMA).repartition(3)


def pandas_rows(rows=None) -> pd.DataFrame:
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return pd.DataFrame(rows if rows is not None else random_rows(), columns=names).sort_values(
        ["TransactionDT", "TransactionID"]).reset_index(drop=True)


def collected(df, order: str = "TransactionID") -> pd.DataFrame:
    return df.toPandas().sort_values(order).reset_index(drop=True)


def same(a, b, digits: int = 9) -> None:
    """Column by column, missing equals missing."""
    assert len(a) == len(b)
    for x, y in zip(a, b):
        if pd.isna(x) or pd.isna(y):
            assert pd.isna(x) and pd.isna(y), (x, y)
        elif isinstance(x, str) or isinstance(y, str):
            assert x == y
        else:
            assert abs(float(x) - float(y)) <= 10 ** -digits * max(1.0, abs(float(y))), (x, y)
