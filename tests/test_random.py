"""All tables over random dirty raw data with heavy keys, against SQL."""

import random
from datetime import datetime, timedelta

import duckdb
import pandas as pd
import pytest
from compare import assert_same

from marketloom.operators import dims, facts, marts
from marketloom.plans import daily, oracle
from marketloom.plans.queries import RUN_TS, whole_as_double
from marketloom.schemas import RAW

START = datetime(2018, 1, 1)


def maybe(rng, value, dirt=(None,), share=0.1):
    return rng.choice(dirt) if rng.random() < share else value


def moment(rng):
    at = START + timedelta(hours=rng.randrange(24 * 90), seconds=rng.randrange(3600))
    return maybe(rng, str(at), (None, "garbage", "2018-02-30"))


def amount(rng):
    return maybe(rng, f"{rng.randrange(100_000) / 100:.2f}", (None, "n/a", "0.00"))


def number(rng, top):
    return maybe(rng, str(rng.randrange(1, top)), (None, "many", " 3 "), 0.05)


def hot(rng, prefix, top):
    """Every third id is the same one."""
    return f"{prefix}hot" if rng.random() < 0.33 else f"{prefix}{rng.randrange(top)}"


def random_raw(seed):
    rng = random.Random(seed)

    def rows(count, make):
        made = [make() for _ in range(count)]
        return made + rng.sample(made, count // 5)  # whole-row copies

    orders = lambda: (
        maybe(rng, hot(rng, "o", 80), share=0.03),
        maybe(rng, hot(rng, "c", 60)),
        maybe(rng, rng.choice(["delivered", "shipped", "cancelled"])),
        *[moment(rng) for _ in range(5)],
    )
    return {
        "orders": rows(120, orders),
        "customers": rows(
            80,
            lambda: (
                maybe(rng, hot(rng, "c", 60), share=0.03),
                maybe(rng, hot(rng, "u", 30)),
                str(rng.randrange(3)),
                maybe(rng, rng.choice([" são paulo", "RIO de janeiro ", "lins"])),
                maybe(rng, rng.choice([" sp", "rj "])),
            ),
        ),
        "order_items": rows(
            400,
            lambda: (
                maybe(rng, hot(rng, "o", 90), share=0.03),
                number(rng, 400),
                maybe(rng, hot(rng, "p", 40), share=0.03),
                maybe(rng, f"s{rng.randrange(6)}"),
                moment(rng),
                amount(rng),
                amount(rng),
            ),
        ),
        "products": rows(
            40,
            lambda: (
                maybe(rng, hot(rng, "p", 40), share=0.03),
                maybe(rng, rng.choice(["moveis", "bebes", "novo"])),
                *[maybe(rng, str(rng.randrange(1, 12_000)), (None, "?", "1.5")) for _ in range(4)],
                number(rng, 9),
            ),
        ),
        "translation": [("moveis", "furniture"), ("bebes", "baby"), (None, "nothing")],
        "payments": rows(
            200,
            lambda: (
                maybe(rng, hot(rng, "o", 90), share=0.03),
                number(rng, 60),
                maybe(rng, rng.choice(["voucher", "boleto", "credit_card"])),
                number(rng, 12),
                amount(rng),
            ),
        ),
        "sellers": rows(
            5,
            lambda: (
                maybe(rng, f"s{rng.randrange(6)}"),
                "1",
                maybe(rng, " lins "),
                maybe(rng, "sp "),
            ),
        ),
    }


@pytest.mark.parametrize("seed", range(4))
def test_every_table(spark, seed):
    data = random_raw(seed)
    duck = duckdb.connect()
    raw = {}
    for name, rows in data.items():
        columns = list(RAW[name])
        frame = pd.DataFrame(rows, columns=columns, dtype="object")
        duck.register(f"frame_{name}", frame)
        texts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)
        duck.execute(f"CREATE TABLE raw_{name} AS SELECT {texts} FROM frame_{name}")
        raw[name] = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
        raw[name] = raw[name].repartition(1 + seed)
    silver = daily.clean_all(raw, RUN_TS)
    fact_inputs = [silver[n] for n in ("order_items", "orders", "payments", "customers")]
    fact = facts.build_fact_orders(*fact_inputs)
    persons = dims.build_dim_customers(silver["customers"], RUN_TS)
    tables = {
        "clean_orders": whole_as_double(silver["orders"]),
        "clean_customers": silver["customers"],
        "clean_order_items": silver["order_items"],
        "clean_products": silver["products"],
        "clean_payments": silver["payments"],
        "clean_sellers": silver["sellers"],
        "dim_customers": persons,
        "dim_products": dims.build_dim_products(silver["products"], RUN_TS),
        "payments_per_order": facts.payments_per_order(silver["payments"]),
        "fact_orders": whole_as_double(fact),
        "fact_orders_left": whole_as_double(facts.build_fact_orders(*fact_inputs, how="left")),
        "revenue_by_category": marts.revenue_by_category(fact, silver["products"]),
        "customer_lifetime_value": marts.customer_lifetime_value(fact, persons),
        "seller_performance": marts.seller_performance(fact, silver["sellers"]),
        "category_price_totals": marts.category_price_totals(
            silver["order_items"], silver["products"]
        ),
    }
    given = [f"raw_{name}" for name in data]
    for name, df in tables.items():
        assert_same(df, duck, oracle.statement(name, given)), name
