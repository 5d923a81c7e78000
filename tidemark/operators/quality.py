"""Row validation and cleaning as column expressions.

A rule list is evaluated on every row in one pass on the executors: it adds ``_errors``, an
array of texts, empty for a valid row. Per field the first failing check is reported.
Checks see the raw value; cleaning comes after; record checks see the cleaned values and
run only where every field passed. Optional fields may be null.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import is_email, strip, title_case

ERRORS = "_errors"

# What the enumerated fields accept (case matters), limits and defaults.
DEPARTMENTS = ["Engineering", "Sales", "Marketing", "HR", "Finance"]
ORDER_STATUSES = ["pending", "shipped", "completed", "cancelled"]
ACTIONS = ["view", "click", "add_to_cart", "purchase", "remove_from_cart"]
SESSION_PREFIX = "session_"
MAX_ORDER_TOTAL = 10000
DEFAULT_STATUS = "pending"
DEFAULT_AGE = 30
DEFAULT_SALARY = 50000

# A check is a condition that must hold, with the text for when it does not.
Check = tuple[Column, str | Column]


class InvalidData(ValueError):
    """Raised by ``require_valid``."""


def greater_than(c: Column, bound: int) -> Check:
    return c > bound, f"Input should be greater than {bound}"


def at_least(c: Column, bound: int) -> Check:
    return c >= bound, f"Input should be greater than or equal to {bound}"


def at_most(c: Column, bound: int) -> Check:
    return c <= bound, f"Input should be less than or equal to {bound}"


def min_length(c: Column, n: int) -> Check:
    return F.length(c) >= n, f"String should have at least {n} character{'s' if n > 1 else ''}"


def max_length(c: Column, n: int) -> Check:
    return F.length(c) <= n, f"String should have at most {n} characters"


def one_of(c: Column, values: list[str]) -> Check:
    quoted = [f"'{v}'" for v in values]
    return c.isin(values), f"Input should be {', '.join(quoted[:-1])} or {quoted[-1]}"


@dataclass(frozen=True)
class Rules:
    """Checks per field, required fields, cleaning, and checks on the whole record."""

    name: str
    checks: dict[str, list[Check]]
    required: list[str] = field(default_factory=list)
    clean: dict[str, Column] = field(default_factory=dict)
    record: list[Check] = field(default_factory=list)
    defaults: dict[str, Column] = field(default_factory=dict)
    # Lists of error texts from inside nested fields, each error with its path.
    nested: list[Column] = field(default_factory=list)


def _failed(checks: list[Check]) -> Column:
    """Text of the first check that does not hold; null when all hold or the value is null."""
    return F.coalesce(F.lit(None).cast("string"), *[F.when(~ok, text) for ok, text in checks])


def _field_error(rules: Rules, name: str) -> Column:
    checks = list(rules.checks.get(name, []))
    if name in rules.required:
        checks.insert(0, (F.col(name).isNotNull(), "Field required"))
    return F.concat(F.lit(f"Field '{name}': "), _failed(checks))


def validate(df: DataFrame, rules: Rules) -> DataFrame:
    """Fill defaults, check, clean. Rows keep their raw values where a field failed."""
    filled = df.withColumns({c: F.coalesce(F.col(c), v) for c, v in rules.defaults.items()})
    names = [c for c in filled.columns if c in rules.checks or c in rules.required]
    errors = F.array_compact(F.array(*[_field_error(rules, c) for c in names]))
    checked = filled.withColumn(ERRORS, F.concat(errors, *rules.nested) if rules.nested else errors)
    valid = F.size(ERRORS) == 0
    cleaned = checked.withColumns({c: F.when(valid, v).otherwise(F.col(c)) for c, v in rules.clean.items()})
    if not rules.record:
        return cleaned
    record_error = F.when(F.size(ERRORS) == 0, _failed(rules.record))
    return cleaned.withColumn(
        ERRORS, F.when(record_error.isNotNull(), F.array(record_error)).otherwise(F.col(ERRORS))
    )


def accepted(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size(ERRORS) == 0).drop(ERRORS)


def rejected(validated: DataFrame) -> DataFrame:
    return validated.filter(F.size(ERRORS) > 0)


def write_split(validated: DataFrame, path: str, mode: str = "error") -> None:
    """Accepted and rejected rows in one pass, below ``valid=true`` and ``valid=false``."""
    validated.withColumn("valid", F.size(ERRORS) == 0).write.mode(mode).partitionBy("valid").parquet(path)


def summary(validated: DataFrame) -> DataFrame:
    """Rows, valid, invalid and rate in one aggregate; the rate of no rows is 0."""
    counts = validated.agg(
        F.count("*").alias("total_records"),
        F.count_if(F.size(ERRORS) == 0).alias("valid_count"),
        F.count_if(F.size(ERRORS) > 0).alias("invalid_count"),
    )
    rate = F.coalesce(F.try_divide("valid_count", "total_records"), F.lit(0.0))
    return counts.withColumn("validation_rate", rate)


def first_rejected(validated: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """The first ``n`` rejected rows by ``order``; each task keeps at most ``n``."""
    return rejected(validated).orderBy(*order).limit(n)


def error_report(validated: DataFrame) -> DataFrame:
    """How often each field error occurred."""
    errors = validated.select(F.explode(ERRORS).alias("error"))
    return errors.groupBy("error").agg(F.count("*").alias("n"))


def require_valid(validated: DataFrame, order: list[str], shown: int = 5) -> DataFrame:
    """The accepted rows, or ``InvalidData`` with the number of bad rows and the first few."""
    bad = summary(validated).first()["invalid_count"]
    if bad:
        first = [row[ERRORS] for row in first_rejected(validated, order, shown).select(ERRORS).collect()]
        raise InvalidData(f"Batch validation failed with {bad} errors: {first}")
    return accepted(validated)


# ------------------------------------------------------------------------------ rule lists


def customer_rules() -> Rules:
    name, city = F.col("name"), F.col("city")
    not_blank = (strip(name) != "", "Value error, Name cannot be empty or whitespace")
    return Rules(
        "customer",
        checks={
            "customer_id": [greater_than(F.col("customer_id"), 0)],
            "name": [min_length(name, 1), max_length(name, 100), not_blank],
            "age": [at_least(F.col("age"), 18), at_most(F.col("age"), 120)],
            "city": [max_length(city, 50)],
            "salary": [at_least(F.col("salary"), 0)],
            "department": [one_of(F.col("department"), DEPARTMENTS)],
        },
        required=["customer_id", "name"],
        clean={"name": title_case(strip(name)), "city": title_case(strip(city))},
    )


def order_rules() -> Rules:
    product, price = F.col("product_name"), F.col("price")
    order_total = F.col("quantity") * price
    shown = order_total.cast("decimal(38,2)").cast("string")
    too_much = F.concat(
        F.lit("Value error, Order total $"), shown, F.lit(" exceeds maximum allowed ($10,000)")
    )
    within = F.when(price == 0, True).otherwise(order_total <= MAX_ORDER_TOTAL)
    return Rules(
        "order",
        checks={
            "order_id": [greater_than(F.col("order_id"), 0)],
            "customer_id": [greater_than(F.col("customer_id"), 0)],
            "product_name": [min_length(product, 1), max_length(product, 100)],
            "quantity": [greater_than(F.col("quantity"), 0)],
            "price": [greater_than(price, 0)],
            "status": [one_of(F.col("status"), ORDER_STATUSES)],
        },
        required=["order_id", "customer_id", "product_name", "quantity", "price"],
        # Half-even, as Python rounds decimals.
        clean={"product_name": title_case(strip(product)), "price": F.bround(price, 2)},
        record=[(within, too_much)],
        defaults={"status": F.lit(DEFAULT_STATUS)},
    )


def activity_rules() -> Rules:
    product = F.col("product")
    return Rules(
        "user_activity",
        checks={
            "user_id": [greater_than(F.col("user_id"), 0)],
            "action": [one_of(F.col("action"), ACTIONS)],
            "product": [max_length(product, 100)],
            "value": [at_least(F.col("value"), 0)],
        },
        required=["timestamp", "user_id", "action"],
        clean={"product": F.lower(strip(product))},
    )


def transaction_rules() -> Rules:
    product, city = F.col("product_id"), F.col("city")
    return Rules(
        "transaction",
        checks={
            "user_id": [greater_than(F.col("user_id"), 0)],
            "product_id": [min_length(product, 1)],
            "amount": [greater_than(F.col("amount"), 0)],
            "city": [max_length(city, 50)],
        },
        required=["event_time", "user_id", "product_id", "amount"],
        clean={"product_id": F.upper(strip(product)), "city": title_case(strip(city))},
    )


def live_rules() -> Rules:
    session = F.col("session_id")
    prefixed = (session.startswith(SESSION_PREFIX), f'Value error, Session ID must start with "{SESSION_PREFIX}"')
    return Rules(
        "live_data",
        checks={
            "user_id": [greater_than(F.col("user_id"), 0)],
            "action": [one_of(F.col("action"), ACTIONS)],
            "value": [at_least(F.col("value"), 0)],
            "session_id": [min_length(session, 1), prefixed],
        },
        required=["timestamp", "user_id", "action", "session_id"],
    )


def member_errors(path: Column, members: list[tuple[str, Column, list[Check], bool]]) -> Column:
    """One error at most for each member ``(name, value, checks, required)``, with its full path."""
    errors = []
    for name, value, checks, required in members:
        missing = [(value.isNotNull(), "Field required")] if required else []
        errors.append(F.concat(F.lit("Field '"), path, F.lit(f".{name}': "), _failed([*missing, *checks])))
    return F.array_compact(F.array(*errors))


def each_error(values: Column, path: Column, errors) -> Column:
    """All errors of a list's members; ``errors`` takes a member and its path (``list.0``)."""
    found = F.transform(values, lambda x, i: errors(x, F.concat(path, F.lit("."), i.cast("string"))))
    return F.coalesce(F.flatten(found), F.array().cast("array<string>"))


def nested_rules() -> Rules:
    """Rules on a nested record. Every member at fault is named by its path, the first fault of each."""
    user, orders = F.col("user_info"), F.col("orders")
    positive = lambda c: [greater_than(c, 0)]
    user_errors = member_errors(F.lit("user_info"), [
        ("user_id", user["user_id"], positive(user["user_id"]), True),
        ("name", user["name"], [min_length(user["name"], 1)], True),
        ("email", user["email"], [(is_email(user["email"]), "String should match the e-mail pattern")], False),
    ])

    def item_errors(item: Column, path: Column) -> Column:
        return member_errors(path, [
            ("product_id", item["product_id"], [min_length(item["product_id"], 1)], True),
            ("quantity", item["quantity"], positive(item["quantity"]), True),
            ("price", item["price"], positive(item["price"]), True),
        ])

    def order_errors(order: Column, path: Column) -> Column:
        items = order["items"]
        return F.concat(
            member_errors(path, [
                ("order_id", order["order_id"], positive(order["order_id"]), True),
                ("items", items, [(F.size(items) >= 1, "List should have at least 1 item")], True),
            ]),
            each_error(items, F.concat(path, F.lit(".items")), item_errors),
            member_errors(path, [
                ("order_date", order["order_date"], [], True),
                ("total", order["total"], positive(order["total"]), True),
            ]),
        )

    return Rules(
        "nested",
        checks={"id": positive(F.col("id"))},
        required=["id", "user_info"],
        nested=[
            F.when(user.isNotNull(), user_errors).otherwise(F.array().cast("array<string>")),
            each_error(orders, F.lit("orders"), order_errors),
        ],
    )
