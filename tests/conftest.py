"""Shared session, and two small shops as landing rows: one told by hand, one generated."""

from __future__ import annotations

import sys
from datetime import date, timedelta
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from orderlens.contracts import RAW_BY_TABLE, RAW_TABLES  # noqa: E402

Rows = dict[str, list[dict]]
"""Of each landing table its rows, by column name."""


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("orderlens-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.default.parallelism", "1")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


class Shop:
    """Collects landing rows. Columns that are not given are blank."""

    def __init__(self):
        self.rows: Rows = {raw.table: [] for raw in RAW_TABLES}

    def add(self, table: str, *values, **named) -> None:
        columns = RAW_BY_TABLE[table].columns
        self.rows[table].append(dict.fromkeys(columns, "") | dict(zip(columns, values)) | named)

    def sell(self, number: str, person: str, bought: str, days: tuple[int, int], lines, paid, scores, zip_code="4000"):
        """A delivered order of one seller: bought at nine, sent a day later, arrived and promised after so
        many days; lines of (product, price, freight), payments of (type, value), and review scores."""
        start = date.fromisoformat(bought)
        arrived, promised = (str(start + timedelta(days=d)) for d in days)
        self.add("raw_customers", f"c{number}", person, zip_code, "porto claro", "pc")
        self.add(
            "raw_orders", f"o{number}", f"c{number}", "delivered", f"{bought} 09:00:00", f"{bought} 10:30:00",
            f"{start + timedelta(days=1)} 08:00:00", f"{arrived} 17:00:00", f"{promised} 23:00:00",
        )
        for n, (product, price, freight) in enumerate(lines, 1):
            self.add("raw_order_items", f"o{number}", n, product, "s7", f"{bought} 23:59:00", price, freight)
        for n, (kind, value) in enumerate(paid, 1):
            self.add("raw_order_payments", f"o{number}", n, kind, 1, value)
        for n, score in enumerate(scores, 1):
            self.add("raw_order_reviews", f"r{number}-{n}", f"o{number}", score, review_creation_date=arrived)

    def stock(self, product: str, category: str, english: str | None = None) -> None:
        self.add("raw_products", product, category)
        if english:
            self.add("raw_product_category_name_translation", category, english)


def story_rows() -> Rows:
    """Nora buys most, Ivo some and late, Lia little of everything, Tom a gift without value or category."""
    shop = Shop()
    shop.stock("lamp", "luminarias", "lighting")
    shop.stock("novel", "romances", "novels")
    shop.stock("kite", "pipas", "kites")
    shop.stock("riddle", "enigmas")
    shop.add("raw_sellers", "s7", "4000", "porto claro", "pc")
    shop.add("raw_geolocation", "4000", "10.0", "20.0", "porto claro", "pc")
    shop.add("raw_geolocation", "4000", "12.0", "24.0", "porto claro", "PC")
    shop.add("raw_geolocation", "5000", "-3.5", "7.25", "vila nova", "vn")
    shop.sell("101", "nora", "2019-03-04", (3, 6), [("lamp", 500, 20)], [("credit_card", 520)], [5])
    shop.sell("102", "nora", "2019-03-20", (3, 5), [("lamp", 320, 0)], [("voucher", 100), ("credit_card", 220)], [4])
    shop.sell("201", "ivo", "2019-03-11", (9, 6), [("lamp", 70, 5), ("novel", 70, 5)], [("credit_card", 150)], [2, 3])
    small = [(product, 10, 1) for product in ("lamp", "novel", "kite", "kite")]
    shop.sell("301", "lia", "2019-04-02", (3, 7), small, [("boleto", 44)], [3], zip_code="5000")
    shop.sell("401", "tom", "2019-04-08", (2, 4), [("riddle", 0, 0)], [("voucher", 0)], [5], zip_code="5000")
    return shop.rows


def crowd_rows(orders: int = 60) -> Rows:
    """Vera's many orders of one product; every second arrives late."""
    shop = Shop()
    shop.stock("kite", "pipas", "kites")
    shop.add("raw_sellers", "s7", "4000", "porto claro", "pc")
    shop.add("raw_geolocation", "4000", "10.0", "20.0", "porto claro", "pc")
    for n in range(orders):
        price, late = 5 + 2 * n, n % 2 == 1
        bought = str(date(2019, 6, 1) + timedelta(days=n % 3))
        days, score = ((9, 6), 1) if late else ((4, 6), 4)
        shop.sell(f"{n:03d}", "vera", bought, days, [("kite", price, 2)], [("credit_card", price + 2)], [score])
    for customer in shop.rows["raw_customers"]:
        customer["customer_unique_id"] = "vera"
    return shop.rows


def find(rows: Rows, table: str, **match) -> dict:
    """The first row of a table with these values, to be changed in place."""
    return next(r for r in rows[table] if all(r[c] == v for c, v in match.items()))


def land(directory: Path, rows: Rows) -> str:
    """Write rows as the landing files of the contract."""
    directory.mkdir(parents=True, exist_ok=True)
    for raw in RAW_TABLES:
        frame = pd.DataFrame(rows[raw.table], columns=list(raw.columns))
        frame.to_csv(directory / raw.file, index=False, encoding="utf-8")
    return str(directory)


def raw_frames(spark, rows: Rows):
    """Landing rows as raw text frames, without files. Blank text is NULL, as when read from CSV."""
    frames = {}
    for raw in RAW_TABLES:
        text = [[None if r[c] in (None, "") else str(r[c]) for c in raw.columns] for r in rows[raw.table]]
        frames[raw.table] = spark.createDataFrame(text, raw.schema)
    return frames


@pytest.fixture
def story_dir(tmp_path) -> str:
    return land(tmp_path / "landing", story_rows())


@pytest.fixture
def crowd_dir(tmp_path) -> str:
    return land(tmp_path / "landing", crowd_rows())
