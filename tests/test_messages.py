import json
from decimal import Decimal

from ovenbird.plans import messages

VALID = json.dumps({"customer_id": 31, "order_type": "PICKUP", "tax": 99, "note": "x", "items": [
    {"item_id": 4, "quantity": 3, "price": 7.25}, {"item_id": 9, "quantity": 1, "price": 11.5}]})


def _validate(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, j string")
    return {r.i: r for r in messages.validate_orders(df, "j").collect()}


def test_sample_orders(spark):
    out = _validate(spark, [VALID, '{"customer_id": null, "items": []}'])
    ok, bad = out[0], out[1]
    assert ok.is_valid and ok.errors == []
    assert (ok.subtotal, ok.tax, ok.total) == (33.25, 2.74, 35.99)  # 3 x 7.25 + 11.50; 8.25 %
    assert json.loads(ok.parsed_order) == {**json.loads(VALID), "subtotal": 33.25, "tax": 2.74, "total": 35.99}
    assert not bad.is_valid
    assert bad.errors == ["Missing required field: customer_id", "Missing required field: order_type",
                          "Order must contain at least one item"]


def test_script_edge_cases(spark):
    out = _validate(spark, [
        '{"a": ',  # not JSON
        "null",  # top-level null: the first property read throws
        '{"customer_id": 1, "order_type": "PICKUP", "items": [{"item_id": 0, "quantity": 1}, null]}',
        '{"customer_id": 1, "order_type": "PICKUP", "items": "abc"}',  # non-array items
        '{"customer_id": 1, "order_type": "X", "items": [{"item_id": "7", "quantity": "2"}]}',
        '{"customer_id": 1, "order_type": "DINE_IN", "items": [{"item_id": "7", "quantity": "2", "price": "3.5"}]}',
        '{"customer_id": 1, "order_type": "DELIVERY", "items": [{"item_id": 2, "quantity": -1}]}',
    ])
    assert out[0].errors == ["JSON parsing error: invalid JSON text"]
    assert out[1].errors == ["JSON parsing error: cannot read order structure"]
    assert out[2].errors == ["Item 1 missing item_id", "JSON parsing error: cannot read order structure"]
    assert out[3].errors == ["JSON parsing error: cannot read order structure"]
    assert out[4].errors == ["Invalid order_type. Must be: DELIVERY, PICKUP, DINE_IN"]
    assert out[5].is_valid and out[5].subtotal == 7.0 and out[5].tax == 0.58
    assert out[6].errors == ["Item 1 has invalid quantity", "Delivery orders require delivery_address"]


def test_email_templates(spark):
    cust = spark.createDataFrame([(1, "Ann", "Lee", "a@x", 420), (2, "Bo", "Ng", "b@x", 700)],
                                 "customer_id bigint, first_name string, last_name string, email string, loyalty_points int")
    orders = spark.createDataFrame([(1, Decimal("10.50"))], "customer_id bigint, total_amount decimal(10,2)")
    req = spark.createDataFrame([(1, "LOYALTY_UPDATE"), (2, "LOYALTY_UPDATE"), (1, "BOGUS"), (9, "WELCOME")],
                                "customer_id bigint, email_type string")
    out = {(r.customer_id, r.email_type): r for r in messages.email_content(cust, orders, req).collect()}
    assert "Just 80 more points until Silver status!" in out[(1, "LOYALTY_UPDATE")].body
    assert "You've ordered 1 times" in out[(1, "LOYALTY_UPDATE")].body
    assert "You're a Silver member!" in out[(2, "LOYALTY_UPDATE")].body
    assert out[(1, "BOGUS")].subject.startswith("Welcome to ")  # unknown type -> welcome text
    assert not out[(9, "WELCOME")].success and out[(9, "WELCOME")].error == "Customer not found"


def test_staged_payload_drops_null_keys(spark):
    cust = spark.createDataFrame([(1, None, "1 Main St"), (2, "b@x", "2 Main St")],
                                 "customer_id bigint, email string, address string")
    rows = {r.customer_id: r for r in messages.staged_online_orders(cust).collect()}
    assert "customer_email" not in rows[1].raw_payload
    assert '"customer_email":"b@x"' in rows[2].raw_payload
    assert '"total":28.99' in rows[2].raw_payload and rows[2].raw_order_id.startswith("ONLINE-")


def _order(**change):
    return json.dumps({**json.loads(VALID), **change})


# The typed parse is more lenient than the rules in these; all must come out alike.
ODD_ORDERS = [
    VALID, f"[{VALID}]", " \n\t" + VALID, VALID + " x", VALID.replace("31", "031"), VALID.replace('"', "'"),
    VALID.replace('"note"', '"order_type"'), VALID.replace("PICKUP", "Pickup"), _order(order_type=5), _order(order_type=None),
    _order(customer_id="31"), _order(customer_id=3.5), _order(customer_id=0), _order(customer_id=1 << 70), _order(items={}),
    _order(items=[]), _order(items=[None]), _order(items=[5]), _order(items=[[{"item_id": 1, "quantity": 1, "price": 1}]]),
    _order(items={"item_id": 1, "quantity": 2, "price": 3}), _order(order_type="DELIVERY"),
    *[_order(order_type="DELIVERY", delivery_address=a) for a in ("", "x", 0, 7, [], None, False)],
    *[_order(items=[{"item_id": 2, "quantity": 1, "price": 1.1}, {"item_id": i, "quantity": q, "price": p, "size": "L"}])
      for i, q, p in [(0, 1, 2.5), ("", 1, 2.5), ("7", 1, 2.5), (3, 0, 1), (3, 1.5, 2), (3, "2", 1), (3, True, 1), (3, 1, 0),
                      (3, 1, "NaN"), (3, 1, "Infinity"), (3, 2, -1.25), (3, 1, None), (None, 1, 1), (3, None, 1), (1.5, 1, 1)]],
    VALID.replace("7.25", "1e400"), VALID.replace("7.25", "NaN"), VALID.replace("7.25", "0.1234567890123456789"),
    VALID.replace('"price": 7.25', '"price": 1, "price": 7.25'), "", "{}", "[]", "5", '"x"']


def test_typed_parse_changes_nothing(spark, monkeypatch):
    from pyspark.sql import functions as F

    fast = {i: tuple(r) for i, r in _validate(spark, ODD_ORDERS).items()}
    assert fast[0][2] and not fast[1][2] and fast[2][2]
    monkeypatch.setattr(messages, "_typed_valid", lambda *a: F.lit(False))
    slow = {i: tuple(r) for i, r in _validate(spark, ODD_ORDERS).items()}
    for i, text in enumerate(ODD_ORDERS):
        assert repr(fast[i]) == repr(slow[i]), text
