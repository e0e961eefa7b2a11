"""Small till exports with every case the loader has to cope with."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

ZONE = timezone(timedelta(hours=5, minutes=30))

PRODUCTS = [
    # product_sk, code, name, category, valid_from, valid_to
    (1, "A1", "Soap", "C01", "2019-01-01", "2024-05-31"),
    (2, "A1", "Lamp", "C02", "2024-06-01", "9999-12-31"),
    (3, "B2", "Rice", "C03", "2019-01-01", "9999-12-31"),
]
REVISIONS = [
    # revision_id, product_sk, selling_price, effective_from, effective_to
    (1, 1, "10.00", "2022-01-01", "9999-12-31"),
    (2, 2, "90.00", "2024-06-01", "9999-12-31"),
    (3, 3, "50.00", "2022-01-01", "2024-07-14"),
    (4, 3, "55.00", "2024-07-15", "9999-12-31"),
]

# Bills: (store, business date, bill, [(line, code, qty, price, type, time)])
DAY = "2024-07-02"
BILLS = [
    ("S01", "2024-05-30", "S01-20240530-1", [
        (1, "A1", "2", "10.00", "SALE", "2024-05-30T10:00:00"),
        (2, "", "1", "-1.00", "DISCOUNT", "2024-05-30T10:00:00"),
        (3, "", "1", "3.40", "TAX", "2024-05-30T10:00:00"),
        (4, "", "1", "22.40", "TENDER", "2024-05-30T10:00:00"),
    ]),
    ("S01", DAY, "S01-20240702-1", [
        (1, "A1", "1", "90.00", "SALE", "2024-07-02T23:10:00"),
        (2, "B2", "1.500", "50.00", "SALE", "2024-07-02T23:10:00"),
    ]),
    ("S01", DAY, "S01-20240702-2", [
        (1, "B2", "-1", "50.00", "RETURN", "2024-07-03T00:40:00"),
    ]),
    ("S01", DAY, "S01-20240702-3", [
        (1, "B2", "4", "50.00", "SALE", "2024-07-02T12:00:00"),
        (2, "B2", "-4", "50.00", "VOID", "2024-07-02T12:05:00"),
    ]),
    ("S07", DAY, "S07-20240702-1", [
        (1, "B2", "2", "50.00", "SALE", "2024-07-02T09:00:00"),
        (2, "ZZ", "1", "7.00", "SALE", "2024-07-02T09:00:00"),
    ]),
    ("S07", "2024-07-05", "S07-20240705-1", [
        (1, "B2", "1", "50.00", "SALE", "2024-07-05T09:00:00"),
    ]),
    ("S11", DAY, "S11-20240702-1", [
        (1, "B2", "3", "50.00", "SALE", "2024-07-02T18:30:00"),
    ]),
    # Printed price not yet synced: the list price changed on 15 July.
    ("S11", "2024-07-16", "S11-20240716-1", [
        (1, "B2", "1", "50.00", "SALE", "2024-07-16T18:30:00"),
        (2, "B2", "1", "55.00", "SALE", "2024-07-16T18:30:00"),
    ]),
]


def _iso(rows):
    head = "bill_no,line_no,product_code,qty,unit_price,line_type,ts"
    return "\n".join([head, *[f"{b},{n},{c},{q},{p},{t},{at}" for b, n, c, q, p, t, at in rows]]) + "\n"


def _semicolon(rows):
    head = "bill_no;line_no;item_code;quantity;rate;type;txn_time"
    at = lambda s: datetime.fromisoformat(s).strftime("%d-%m-%Y %H:%M:%S")
    return "\n".join([head, *[f"{b};{n};{c};{q};{p};{t};{at(s)}" for b, n, c, q, p, t, s in rows]]) + "\n"


def _epoch(rows):
    head = "ts,line_type,bill_no,line_no,qty,unit_price,product_code"
    at = lambda s: int(datetime.fromisoformat(s).replace(tzinfo=ZONE).timestamp())
    return "﻿" + "\n".join([head, *[f"{at(s)},{t},{b},{n},{q},{p},{c}" for b, n, c, q, p, t, s in rows]]) + "\n"


def render(store: str, rows) -> str:
    number = int(store[1:])
    return (_iso if number <= 5 else _semicolon if number <= 9 else _epoch)(rows)


def file_rows():
    files: dict[tuple[str, str], list] = {}
    for store, date, bill, lines in BILLS:
        files.setdefault((store, date), []).extend((bill, *line) for line in lines)
    return files


def write_exports(folder: str) -> None:
    root = Path(folder)
    for (store, date), rows in file_rows().items():
        name = f"SALES_{store}_{date.replace('-', '')}"
        (root / f"{name}.csv").write_text(render(store, rows), encoding="utf-8")
        if (store, date) == ("S07", DAY):  # complete re-send, byte for byte
            (root / f"{name}__R1.csv").write_text(render(store, rows), encoding="utf-8")
        if (store, date) == ("S01", DAY):  # re-sends cut off after the first bill, then after the second
            (root / f"{name}__R1.csv").write_text(render(store, rows[:2]), encoding="utf-8")
            (root / f"{name}__R2.csv").write_text(render(store, rows[:3]), encoding="utf-8")
    broken = [("S02-20240702-1", 1, "B2", "two", "50.00", "SALE", "2024-07-02T09:00:00"),
              ("S02-20240702-1", 2, "B2", "2", "50.00", "SALE", "2024-07-02T09:00:00")]
    (root / "SALES_S02_20240702.csv").write_text(render("S02", broken), encoding="utf-8")
    table = pa.table({
        "bill_no": ["S03-20240702-1"], "line_no": pa.array([1], pa.int32()), "product_code": ["B2"],
        "qty": pa.array([5.0]), "unit_price": pa.array([50.0]), "line_type": ["SALE"], "ts": ["2024-07-02T11:00:00"],
    })
    pq.write_table(table, root / "SALES_S03_20240702.parquet")


def masters(spark):
    products = spark.createDataFrame(PRODUCTS, "product_sk bigint, product_code string, product_name string, "
                                     "category_id string, f string, t string").selectExpr(
        "product_sk", "product_code", "product_name", "category_id", "date(f) valid_from", "date(t) valid_to")
    revisions = spark.createDataFrame(REVISIONS, "revision_id bigint, product_sk bigint, p string, f string, t string").selectExpr(
        "revision_id", "product_sk", "cast(p as decimal(12,2)) selling_price", "date(f) effective_from", "date(t) effective_to")
    return products, revisions
