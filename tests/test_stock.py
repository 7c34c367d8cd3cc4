import random

from pyspark.sql import functions as F

from loomstar.operators.stock import REFUSED, SOLD, apply_sales


def replay(fact, requests, products, users):
    """The requests one after another, as a stored procedure would take them."""
    facts = [dict(zip(("sale_key", "product_key", "price", "stock"), f)) for f in fact]
    out = {}
    for no, sale, user, product, quantity in requests:
        key = products.get(product)
        mine = [f for f in facts if key is not None and f["product_key"] == key]
        if quantity <= 0 or not any(f["stock"] >= quantity for f in mine):
            out[no] = (None, None, REFUSED)
            continue
        price = min(mine, key=lambda f: f["sale_key"])["price"]
        stock = min(f["stock"] for f in mine) - quantity
        facts.append({"sale_key": 10**9 + no, "product_key": key, "price": price, "stock": stock})
        out[no] = (stock, price * quantity, SOLD)
    return out


def test_batch_equals_replay(spark):
    draw = random.Random(11)
    fact = [(i, 100 + i % 9, float(i), draw.randrange(0, 40)) for i in range(30)]
    products = {p: 100 + p for p in range(8)}
    users = {u: 50 + u for u in range(5)}
    requests = [(n, 1000 + n, draw.randrange(7), 3 if draw.random() < 0.4 else draw.randrange(10), draw.randrange(-1, 45)) for n in range(800)]
    expected = replay(fact, requests, products, users)
    for hot_rows in (10**9, 20):
        out = apply_sales(
            spark.createDataFrame(fact, "sale_key int, product_key int, price double, stock int"),
            spark.createDataFrame(requests, "request_no int, sale_id int, user_id int, product_id int, quantity int").repartition(5),
            spark.createDataFrame(list(products.items()), "product_id int, product_key int"),
            spark.createDataFrame(list(users.items()), "user_id int, user_key int"),
            "2024-05-01",
            hot_rows=hot_rows,
        )
        got = out.collect()
        assert {r.request_no: (r.stock, r.total_sale, r.notice) for r in got} == expected
        by_no = {n: u for n, _, u, _, _ in requests}
        assert all(r.user_key == users.get(by_no[r.request_no]) for r in got)
        assert all((r.sale_date is not None) == r.accepted for r in got)
        assert any(r.stock is not None and r.stock < 0 for r in got)
    assert out.where(F.col("accepted")).count() > 0
