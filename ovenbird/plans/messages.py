"""Message-shaped jobs: order JSON validation, customer e-mail content and
staged online orders.  All built from built-in expressions (variant paths,
higher-order array functions, string templates) — no per-row Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import money
from ..functions.variant import json_text, object_of

# Validation rules and messages of the order validator.
REQUIRED_FIELDS = ["customer_id", "items", "order_type"]
VALID_ORDER_TYPES = ["DELIVERY", "PICKUP", "DINE_IN"]
TAX_RATE = 0.0825
MSG_MISSING = "Missing required field: "
MSG_EMPTY = "Order must contain at least one item"
MSG_BAD_TYPE = "Invalid order_type. Must be: DELIVERY, PICKUP, DINE_IN"
MSG_NO_ADDRESS = "Delivery orders require delivery_address"
MSG_PARSE = "JSON parsing error: "
PARSE_TAIL_TEXT = "invalid JSON text"
PARSE_TAIL_SHAPE = "cannot read order structure"


def vtype(x: Column) -> Column:
    """Type name of a variant value ('VOID' for JSON null, NULL if absent)."""
    return F.schema_of_variant(x)


def truthy_typed(t: Column, x: Column) -> Column:
    """Script truthiness of a variant value ``x`` whose type name is ``t``:
    absent, null, false, 0, NaN and "" are false; everything else (objects
    and arrays included) is true."""
    return (F.when(x.isNull() | F.is_variant_null(x), False)
            .when(t == "BOOLEAN", F.variant_get(x, "$", "boolean"))
            .when(t == "STRING", F.length(F.variant_get(x, "$", "string")) > 0)
            .when(t.startswith("OBJECT") | t.startswith("ARRAY"), True)
            .otherwise(F.coalesce(F.try_variant_get(x, "$", "double") != 0, F.lit(False))))


def truthy(x: Column) -> Column:
    return truthy_typed(vtype(x), x)


def present(x: Column) -> Column:
    """``hasOwnProperty(f) && value !== null``: present and not JSON null."""
    return x.isNotNull() & ~F.is_variant_null(x)


def as_number(x: Column) -> Column:
    """Numeric coercion (NULL when not a number or numeric string)."""
    return F.try_variant_get(x, "$", "double")


def _number(x: Column) -> Column:
    """A double as a VARIANT number; a whole one prints without a fraction."""
    return F.when(x == F.floor(x), F.floor(x).cast("bigint").cast("variant")).otherwise(x.cast("variant"))


def _non_null(arr: Column) -> Column:
    return F.filter(arr, lambda e: e.isNotNull())


def _item_info(it: Column) -> Column:
    """Per array element, the fields the rules read, each typed once (lambda
    bodies are not code-generated, so repeated sub-expressions would be
    evaluated again)."""
    fid = F.variant_get(it, "$.item_id", "variant")
    qty = F.variant_get(it, "$.quantity", "variant")
    price = F.variant_get(it, "$.price", "variant")
    return F.struct(F.is_variant_null(it).alias("nul"),
                    fid.alias("vid"), vtype(fid).alias("tid"),
                    qty.alias("vq"), vtype(qty).alias("tq"),
                    price.alias("vp"), vtype(price).alias("tp"))


def _item_errors(info: Column, i: Column) -> Column:
    pos = (i + 1).cast("string")
    return _non_null(F.array(
        F.when(~truthy_typed(info["tid"], info["vid"]), F.concat(F.lit("Item "), pos, F.lit(" missing item_id"))),
        F.when(~truthy_typed(info["tq"], info["vq"]) | F.coalesce(as_number(info["vq"]) <= 0, F.lit(False)),
               F.concat(F.lit("Item "), pos, F.lit(" has invalid quantity")))))


def _price_times_qty(acc: Column, info: Column) -> Column:
    p = F.when(truthy_typed(info["tp"], info["vp"]), as_number(info["vp"])).otherwise(F.lit(0.0))
    return acc + p * as_number(info["vq"])


#: The shape of an order that the typed parse reads.
ORDER_SHAPE = ("customer_id bigint, order_type string, items array<struct<item_id bigint, quantity bigint, price double>>, "
               "unreadable string")


def _typed_valid(text: Column, v: Column, order: Column) -> Column:
    """Whether the typed parse alone shows that an order passes every rule: all
    fields have the usual types and values.  Whatever else is true of a row,
    it goes through the rules on variants."""
    items = order["items"]
    good_item = F.forall(items, lambda x: F.coalesce(
        (x["item_id"] != 0) & (x["quantity"] > 0) & (F.abs(x["price"]) < float("inf")), F.lit(False)))
    addressed = F.when(order["order_type"] == "DELIVERY", truthy(F.variant_get(v, "$.delivery_address", "variant"))
                       ).otherwise(True)
    # The parser takes the first object of an array for the order; a leading brace rules that out.
    return F.coalesce(
        v.isNotNull() & F.ltrim(text, F.lit(" \t\r\n")).startswith("{") & order["unreadable"].isNull()
        & order["customer_id"].isNotNull() & order["order_type"].isin(*VALID_ORDER_TYPES)
        & (F.size(items) > 0) & good_item & addressed, F.lit(False))


def validate_orders(df: DataFrame, json_col: str) -> DataFrame:
    """Validate order JSON text per row.

    Adds ``is_valid``, ``errors`` (array, in rule order), ``parsed_order``
    (canonical JSON with the computed figures, when valid), and ``subtotal`` / ``tax`` / ``total``
    (doubles, rounded half up to cents) when valid.

    The rule steps are separate projections: each intermediate is computed
    once per row and referenced by name, instead of one expression tree that
    repeats the parse and the array walks in every branch.  Orders of the usual
    shape are read by one typed parse; only the others walk their variants.
    """
    keep = df.columns
    text = F.col(json_col)
    s1 = df.select("*", F.try_parse_json(text).alias("__whole"), F.from_json(
        text, ORDER_SHAPE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "unreadable"}).alias("__order"))
    s1 = s1.select("*", _typed_valid(text, F.col("__whole"), F.col("__order")).alias("__typed"))
    typed = F.col("__typed")
    s1 = s1.select("*", F.when(~typed, F.col("__whole")).alias("__v"))
    v = F.col("__v")

    def field(name):
        return F.variant_get(v, f"$.{name}", "variant")

    s2 = s1.select(
        "*",
        (text.isNotNull() & v.isNull()).alias("__parse_failed"),
        (text.isNull() | F.is_variant_null(v)).alias("__top_null"),
        _non_null(F.array(*[F.when(~present(field(f)), F.lit(MSG_MISSING + f)) for f in REQUIRED_FIELDS]))
        .alias("__base"),
        F.try_variant_get(v, "$.items", "array<variant>").alias("__arr"),
        field("order_type").alias("__ot"),
        field("delivery_address").alias("__addr"))
    arr, ot = F.col("__arr"), F.col("__ot")
    s2 = s2.withColumn("__info", F.transform(arr, _item_info))
    info = F.col("__info")
    # A JSON null element makes the item loop throw: errors of earlier items
    # stay, then the parse error ends validation.
    first_null = F.coalesce(F.array_position(F.transform(info, lambda x: x["nul"]), True), F.lit(0))
    s3 = s2.select(
        "*", first_null.alias("__first_null"),
        F.when(vtype(ot) == "STRING", F.variant_get(ot, "$", "string")).alias("__ot_str"),
        truthy(ot).alias("__ot_truthy"), truthy(F.col("__addr")).alias("__addr_truthy"))
    fn, ot_str = F.col("__first_null"), F.col("__ot_str")
    n_checked = F.when(fn > 0, fn - 1).otherwise(F.size(arr))
    item_errors = F.flatten(F.transform(F.filter(info, lambda it, i: i < n_checked), _item_errors))
    is_arr = arr.isNotNull()
    tail = _non_null(F.array(
        F.when(F.col("__ot_truthy") & ~F.coalesce(ot_str.isin(*VALID_ORDER_TYPES), F.lit(False)),
               F.lit(MSG_BAD_TYPE)),
        F.when(F.coalesce(ot_str == "DELIVERY", F.lit(False)) & ~F.col("__addr_truthy"), F.lit(MSG_NO_ADDRESS))))
    arr_errors = F.when(is_arr, F.concat(_non_null(F.array(F.when(F.size(arr) == 0, F.lit(MSG_EMPTY)))),
                                         item_errors)).otherwise(F.array().cast("array<string>"))
    s4 = s3.select("*", (is_arr & (fn > 0)).alias("__item_throw"), arr_errors.alias("__arr_errors"),
                   tail.alias("__tail"))
    throw = F.col("__item_throw")
    before = F.when(throw, F.concat("__base", "__arr_errors")).otherwise(F.concat("__base", "__arr_errors", "__tail"))
    s5 = s4.select("*", before.alias("__before"))
    b = F.col("__before")
    # The total step walks ``items``; a truthy non-array there throws too.
    total_throws = (F.size(b) == 0) & ~throw & ~is_arr
    shape_error = F.lit(MSG_PARSE + PARSE_TAIL_SHAPE)
    errors = (F.when(typed, F.array().cast("array<string>"))
              .when(F.col("__parse_failed"), F.array(F.lit(MSG_PARSE + PARSE_TAIL_TEXT)))
              .when(F.col("__top_null"), F.array(shape_error))
              .when(throw | total_throws, F.concat(b, F.array(shape_error)))
              .otherwise(b))
    s6 = s5.select("*", errors.alias("errors")).withColumn("is_valid", F.size("errors") == 0)
    valid = F.col("is_valid")
    priced = F.aggregate(F.col("__order.items"), F.lit(0.0), lambda acc, x: acc + x["price"] * x["quantity"])
    s7 = s6.select("*", F.when(typed, priced).when(valid, F.aggregate(info, F.lit(0.0), _price_times_qty)).alias("subtotal"))
    sub = F.col("subtotal")
    s8 = s7.select("*", money.js_round2(sub * TAX_RATE).alias("tax"))
    s9 = s8.select("*", money.js_round2(sub + F.col("tax")).alias("total"))
    figures = ["subtotal", "tax", "total"]
    # The order comes back with the three figures in place of its own.
    fields = F.try_variant_get(F.col("__whole"), "$", "map<string,variant>")
    rest = F.map_filter(fields, lambda k, _: ~k.isin(*figures))
    own = F.create_map(*[x for f in figures for x in (F.lit(f), _number(F.col(f)))])
    parsed = json_text(F.to_variant_object(F.map_concat(rest, own)))
    return s9.select(*keep, "is_valid", "errors", F.when(valid, parsed).alias("parsed_order"), *figures)


# E-mail templates of the four message types and their codes.
# The restaurant's name is a parameter (``brand``); this default is ours.
BRAND = "Forno Verde"
SILVER_AT = 500
EMAIL_TEMPLATES = {
    "WELCOME": (
        "Welcome to {brand}, {first}! 🍕",
        "Dear {first},\n\nWelcome to the {brand} family! We're thrilled to have you.\n\n"
        "As a welcome gift, enjoy 15% off your first order with code: WELCOME15\n\n"
        "Start earning loyalty points with every purchase - you already have {points} points!\n\n"
        "Buon appetito!\nThe {brand} Team"),
    "ORDER_CONFIRMATION": (
        "Your {brand} Order is Confirmed! 🎉",
        "Hi {first},\n\nGreat news - we've received your order and our kitchen is firing up the ovens!\n\n"
        "You now have {points} loyalty points. Keep ordering to unlock rewards!\n\n"
        "Track your order in the {brand} app.\n\nGrazie mille!\nThe {brand} Team"),
    "LOYALTY_UPDATE": (
        "{first}, You've Earned More Points! ⭐",
        "Hey {first}!\n\nYour loyalty is paying off! You now have {points} points.\n\n"
        "{silver_line}\n\nYou've ordered {orders} times and we appreciate every single one.\n\n"
        "Keep those points coming!\nThe {brand} Team"),
    "WINBACK": (
        "We Miss You, {first}! 😢🍕",
        "Dear {first},\n\nIt's been a while since your last slice! We miss seeing you.\n\n"
        "Here's 20% off your next order to welcome you back: MISSYOU20\n\n"
        "Your {points} loyalty points are waiting for you!\n\n"
        "Come back soon - your favorite pizza is calling!\n\nWarmly,\nThe {brand} Team"),
}
SILVER_REACHED = "🎊 Congratulations! You're a Silver member!"
SILVER_PENDING = "Just {missing} more points until Silver status!"
EMAIL_TYPES = ["WELCOME", "ORDER_CONFIRMATION", "LOYALTY_UPDATE", "WINBACK"]


def _render(template: str, values: dict[str, Column], brand: str) -> Column:
    """Render a ``{name}`` template into a concat of literals and columns."""
    import re
    parts, pos = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        key = m.group(1)
        parts.append(F.lit(brand) if key == "brand" else values[key])
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def _js_text(c: Column) -> Column:
    """Template interpolation of a possibly NULL value prints 'null'."""
    return F.coalesce(c.cast("string"), F.lit("null"))


def email_content(customers: DataFrame, orders: DataFrame, requests: DataFrame,
                  brand: str = BRAND) -> DataFrame:
    """E-mail content per (customer_id, email_type) request.  Unknown types get
    the WELCOME text but echo the requested type; unknown customers get
    ``success = false`` and an error."""
    per = orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("total_orders"),
                                            F.sum("total_amount").alias("lifetime_value"))
    c = customers.select("customer_id", "first_name", "last_name", "email", "loyalty_points")
    c = c.join(per, "customer_id", "left").select(
        "customer_id", "first_name", "last_name", "email", "loyalty_points",
        F.coalesce(F.col("total_orders"), F.lit(0)).alias("total_orders"),
        F.coalesce(F.col("lifetime_value"), F.lit(0)).alias("lifetime_value"), F.lit(True).alias("__found"))
    r = requests.join(c, "customer_id", "left")
    pts = F.col("loyalty_points")
    values = {
        "first": _js_text(F.col("first_name")),
        "points": _js_text(pts),
        "orders": _js_text(F.col("total_orders")),
        "silver_line": F.when(pts >= SILVER_AT, F.lit(SILVER_REACHED)).otherwise(
            _render(SILVER_PENDING, {"missing": _js_text(F.lit(SILVER_AT) - pts)}, brand)),
    }
    t = F.col("email_type")
    subject = body = None
    for name in EMAIL_TYPES:
        subj_t, body_t = EMAIL_TEMPLATES[name]
        s_c, b_c = _render(subj_t, values, brand), _render(body_t, values, brand)
        subject = F.when(t == name, s_c) if subject is None else subject.when(t == name, s_c)
        body = F.when(t == name, b_c) if body is None else body.when(t == name, b_c)
    w_subj, w_body = EMAIL_TEMPLATES["WELCOME"]
    subject = subject.otherwise(_render(w_subj, values, brand))
    body = body.otherwise(_render(w_body, values, brand))
    found = F.coalesce(F.col("__found"), F.lit(False))
    return r.select(
        "customer_id", "email_type", found.alias("success"),
        F.when(~found, F.lit("Customer not found")).alias("error"),
        F.when(found, F.col("email")).alias("recipient"),
        F.when(found, subject).alias("subject"), F.when(found, body).alias("body"),
        "first_name", "last_name", "loyalty_points", "total_orders", "lifetime_value")


def all_customer_requests(customers: DataFrame, types=None) -> DataFrame:
    """One request per customer and e-mail type (a per-row explode, not a join)."""
    types = types or EMAIL_TYPES
    return customers.select("customer_id", F.explode(F.array(*[F.lit(x) for x in types])).alias("email_type"))


# The sample staged payload.
STAGED_ITEMS = [("Pepperoni", "Large", 1), ("Garlic Knots", "N/A", 2)]
STAGED_TOTAL = "28.99"


def staged_online_orders(customers: DataFrame) -> DataFrame:
    """Staged online orders with a semi-structured payload per customer.  The
    id is 'ONLINE-' plus a hash of the customer key, so re-runs give the same ids."""
    items = F.array(*[F.struct(F.lit(i).alias("item"), F.lit(s).alias("size"), F.lit(q).alias("qty"))
                      for i, s, q in STAGED_ITEMS])
    payload = object_of(customer_email=F.col("email"), items=items,
                        total=F.lit(STAGED_TOTAL).cast("decimal(4,2)"),
                        delivery_address=F.col("address"), order_source=F.lit("WEBSITE"))
    return customers.select(
        F.concat(F.lit("ONLINE-"), F.sha2(F.col("customer_id").cast("string"), 256)).alias("raw_order_id"),
        "customer_id",
        json_text(payload).alias("raw_payload"),
        F.lit("WEB_APP").alias("source_system"),
        F.lit(False).alias("processed_flag"))
