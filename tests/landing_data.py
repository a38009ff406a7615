"""A small, hand-written landing folder that passes every test, and its edge cases."""

import csv
from pathlib import Path

from tidemark.schemas import RAW_COLUMNS

ROWS = {
    "customers": [
        ("c1", "p1", " 01-310 ", " SAO PAULO-sp ", "sp"),
        ("c2", "p1", "123", "rio de janeiro", " RJ "),
        ("c3", "p2", "123456", "campinas", "sp"),
        ("c4", "p3", "4", "lins", "SP"),
        ("c5", "p4", "5", "bauru", "SP"),
    ],
    "geolocation": [
        ("1310", "-23.5", "-46.6", "são paulo", "sp"),
        (" 01310 ", "-23.7", "-46.8", "são paulo", "SP"),
        ("123", "bad", "-43.0", "", "rj"),
    ],
    "orders": [
        # p1: first order kept and delivered across midnight, second cancelled from a new address
        ("o1", "c1", "delivered", "2017-01-30 23:59:00", "2017-01-31 00:10:00", "2017-01-31 08:00:00",
         "2017-01-31 00:01:00", "2017-02-05 00:00:00"),
        ("o2", "c2", "canceled", "2017-02-02 10:00:00", "", "", "", "2017-02-20 00:00:00"),
        # delivered without a date
        ("o3", "c3", "delivered", "2017-02-01 10:00:00", "", "", "", "2017-02-10 00:00:00"),
        # cancelled and without items
        ("o4", "c4", "canceled", "2017-02-01 11:00:00", "", "", "", "garbage"),
        ("o5", "c5", "shipped", "2017-02-02 09:00:00", "", "", "", "2017-02-30 00:00:00"),
    ],
    "order_items": [
        ("o1", "1", "k1", "s1", "2017-02-01 00:00:00", "10.00", "1.50"),
        ("o1", "2", "k2", "s1", "2017-02-01 00:00:00", "20.00", "2.50"),
        ("o2", "1", "k1", "s2", "2017-02-05 00:00:00", "99.99", "0.01"),
        ("o3", "1", "k3", "s2", "2017-02-05 00:00:00", "5.00", "0.00"),
        ("o5", "1", "k1", "s9", "2017-02-05 00:00:00", "7.00", "1.00"),
    ],
    "order_payments": [
        ("o1", "2", "voucher", "1", "4.00"),
        ("o1", "1", "credit_card", "3", "30.00"),
        ("o1", "", "boleto", "1", "0.00"),
        ("o2", "1", "boleto", "1", "100.00"),
        ("o3", "n/a", "boleto", "1", "5.00"),
    ],
    "order_reviews": [
        ("r1", "o1", "5", "ok", 'first line\nsecond "quoted" line', "2017-02-03 00:00:00",
         "2017-02-04 00:00:00"),
        ("r1", "o1", "1", "", "", "2017-02-03 00:00:00", ""),
        ("r2", "o1", "4", "", "one\n\ntwo, three", "2017-02-03 00:00:00", "2017-02-05 00:00:00"),
        ("r3", "o3", "3", "", "", "2017-02-11 00:00:00", "2017-02-12 00:00:00"),
    ],
    "products": [
        ("k1", "moveis", "40", "287", "1", "225", "16", "10", "14"),
        ("k2", "beleza", "40", "287", "1.5", " 12 ", "12.0", "", "14"),
        ("k3", "", "", "", "", "", "", "", ""),
    ],
    "sellers": [("s1", "13023", "campinas", "SP"), ("s2", "9", " lins", "sp ")],
    "product_category_translation": [("moveis", "furniture")],
}


def write_csv(path: Path, header, rows, quote_all=True):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, quoting=csv.QUOTE_ALL if quote_all else csv.QUOTE_MINIMAL, lineterminator="\n")
        out.writerow(header)
        out.writerows(rows)


def write_landing(folder: Path, **changed) -> str:
    """Write all drops; ``changed`` replaces the rows of single tables, None leaves one out."""
    folder.mkdir(parents=True, exist_ok=True)
    for table, rows in {**ROWS, **changed}.items():
        if rows is not None:
            write_csv(folder / f"{table}.csv", RAW_COLUMNS[table], rows)
    return str(folder)
