"""Data quality checks and constraints over the warehouse."""

from __future__ import annotations

from dataclasses import replace

from starloom.catalog.registry import query
from starloom.operators import constraints
from starloom.plans import quality as q
from starloom.schemas import WAREHOUSE

ROW = "check_id:s check_name:s status:s value:i threshold:i message:s"


def _orphans(key: str, dim: str) -> str:
    return f"select count(*) from fact_sales f left join {dim} d on f.{key} = d.{key} where d.{key} is null"


def _repeated(table: str, keys: str) -> str:
    return f"select count(*) from (select {keys} from {table} group by {keys} having count(*) > 1)"


KNOWN = ", ".join(f"'{k}'" for k in q.KNOWN_ZERO_INSTALLMENTS)
VALUES = {
    "QC-01": "select count(*) from fact_sales",
    "QC-02": "select count(*) from fact_sales where customer_key is null",
    "QC-03": "select count(*) from fact_sales where product_key is null",
    "QC-04": "select count(*) from fact_sales where price <= 0",
    "QC-05": "select count(*) from fact_sales where freight_value < 0",
    "QC-06": _repeated("fact_sales", "order_id, order_item_id"),
    "QC-07": "select count(*) from fact_payments",
    "QC-08": "select count(*) from fact_payments where payment_value < 0",
    "QC-09": "select count(*) from fact_payments where customer_key is null",
    "QC-10": f"""select count(*) from fact_payments join dim_payment using (payment_key)
        where payment_type = 'credit_card' and payment_installments < 1 and order_id not in ({KNOWN})""",
    "QC-11": "select count(*) from fact_order_experience",
    "QC-12": "select count(*) from fact_order_experience where delivery_days < 0",
    "QC-13": "select count(*) from fact_order_experience where review_score not between 1 and 5",
    "QC-14": "select count(*) from dim_customer",
    "QC-15": _repeated("dim_customer", "customer_unique_id"),
    "QC-16": "select count(*) from dim_product",
    "QC-17": "select count(*) from dim_date",
    "QC-18": _orphans("customer_key", "dim_customer"),
    "QC-19": _orphans("product_key", "dim_product"),
    "QC-20": _orphans("date_key", "dim_date"),
}
YEARS = """(select date_trunc('year', min(order_purchase_timestamp))::date as lo,
    (date_trunc('year', max(order_purchase_timestamp)) + interval '1' year - interval '1' day)::date as hi from raw_orders) y"""


def _replace_numbers(template: str) -> str:
    text = "'" + template.replace("'", "''") + "'"
    for mark, value in (("n", "n"), ("low", "lo"), ("high", "hi")):
        text = f"replace({text}, '{{{mark}}}', {value}::varchar)" if "{" + mark + "}" in template else text
    return text


def check_sql(check: q.Check, brief: bool = False, gate: bool = False) -> str:
    value = VALUES[check.id]
    if check.kind == q.RANGE:
        if gate:
            value = f"select count(*) from dim_date, {YEARS} where full_date < y.lo or full_date > y.hi"
            passed = "n = 0"
        else:
            passed = "n = days" if brief else "n = days and lo <= want_lo and hi >= want_hi"
    else:
        passed = "n > 0" if check.kind == q.FILLED else "n = 0"
    threshold = {q.FILLED: "1", q.CLEAN: "0", q.RANGE: "days"}[check.kind]
    message = _replace_numbers(check.brief) if brief else f"if({passed}, {_replace_numbers(check.good)}, {_replace_numbers(check.bad)})"
    return f"""select '{check.id}' as check_id, '{check.name}' as check_name, if({passed}, 'PASS', 'FAIL') as status,
        n as value, {threshold} as threshold, {message} as message
    from (select ({value}) as n, (select min(full_date) from dim_date) as lo, (select max(full_date) from dim_date) as hi,
        y.lo as want_lo, y.hi as want_hi, y.hi - y.lo + 1 as days from {YEARS})"""


for _check in q.CHECKS:
    query(f"DQC-{_check.id[3:]}", ROW, check_sql(_check))(
        lambda ws, check=_check: q.check_report(ws.dw, ws.settings, [check.id])
    )

for _rule, _passed in (
    (q.COVERS, "min(full_date) <= y.lo and max(full_date) >= y.hi"),
    (q.NONE_OUTSIDE, "count(*) filter (full_date < y.lo or full_date > y.hi) = 0"),
    (q.EXACT_DAYS, "count(*) = y.hi - y.lo + 1"),
):
    query(
        f"DQC-17-{_rule.replace('_', '-')}",
        "check_id:s status:s value:i",
        f"select 'QC-17' as check_id, if({_passed}, 'PASS', 'FAIL') as status, count(*) as value from dim_date, {YEARS} group by y.lo, y.hi",
    )(lambda ws, rule=_rule: q.check_report(ws.dw, replace(ws.settings, range_rule=rule), ["QC-17"]))

query("DQC-21", ROW, " union all ".join(check_sql(c, brief=True) for c in q.CHECKS if c.brief))(
    lambda ws: q.check_summary(ws.dw, ws.settings)
)
query(
    "DQC-22",
    "check_id:s check_name:s value:i status:s",
    f"select check_id, check_name, value, status from ({' union all '.join(check_sql(c, gate=True) for c in q.CHECKS)})",
)(lambda ws: q.gate_report(ws.dw, ws.settings))

VIOLATIONS = "table_name:s constraint_kind:s column_name:s violations:i"


def _violation(table: str, kind: str, column: str, value: str) -> str:
    return f"select '{table}' as table_name, '{kind}' as constraint_kind, '{column}' as column_name, ({value}) as violations"


def _without_key(table: str, column: str) -> bool:
    """Fact keys have no counterpart in SQL; they are generated, hence never null."""
    return table.startswith("fact_") and column == WAREHOUSE[table].key


query(
    "DQC-23",
    VIOLATIONS,
    " union all ".join(
        _violation(t, "not_null", c, "0" if _without_key(t, c) else f"select count(*) from {t} where {c} is null")
        for t, spec in WAREHOUSE.items()
        for c in spec.required
    ),
)(lambda ws: constraints.not_null_violations(ws.dw))
query(
    "DQC-24",
    VIOLATIONS,
    " union all ".join(
        _violation(t, "unique", ", ".join(s.natural_key), _repeated(t, ", ".join(s.natural_key))) for t, s in WAREHOUSE.items()
    ),
)(lambda ws: constraints.unique_violations(ws.dw))
query(
    "DQC-25",
    VIOLATIONS,
    " union all ".join(
        _violation(t, "foreign_key", k, f"select count(*) from {t} f left join {d} d on f.{k} = d.{k} where d.{k} is null")
        for t, s in WAREHOUSE.items()
        for k, d in s.foreign_keys.items()
    ),
)(lambda ws: constraints.foreign_key_violations(ws.dw))
query(
    "DQC-26",
    VIOLATIONS,
    " union all ".join(
        [
            _violation(t, "check", f"{c} range", f"select count(*) from {t} where {c} not between {lo} and {hi}")
            for t, s in WAREHOUSE.items()
            for c, (lo, hi) in s.ranges.items()
        ]
        + [
            _violation(t, "check", f"{c} length", f"select count(*) from {t} where length({c}) > {n}")
            for t, s in WAREHOUSE.items()
            for c, n in s.lengths.items()
        ]
    ),
)(lambda ws: constraints.check_violations(ws.dw))
