"""Newest state of contracts and payments.

The contract ledger holds one row per contract: its written side ``w`` and its cancelled side
``k``. Building it is the only shuffle of contract rows; feed dedupe, union, written references,
final dedupe, latest state and earned reserve are all decided inside that row. Group sizes do
not matter: ``max_by`` is combined before the shuffle, so a contract with very many snapshots
sends one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pactlens.config import ReportConfig
from pactlens.functions import calendar as cal
from pactlens.functions import scalars as s

CORE = [
    "snapshot_ts", "contract_status", "transaction_type", "activity_date",
    "admin_amount", "reserve_amount", "gross_income_amount",
    "effective_date", "has_schedule", "earning_schedule",
]
NAMES = ["agent", "agent_name", "dealer", "dealer_number", "dealer_name", "product"]
DETAIL = [
    "source_id", "ingest_ord", "coverage_code", "company", "risk_entity", "schedule_last_month",
    "components",
]
ALL = CORE + NAMES + DETAIL


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest row of each key. The limit is applied before the shuffle as well as after it."""
    window = W.partitionBy(*keys).orderBy(*[F.desc(o) for o in order])
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


# Places in the whole transaction list: contract feed, then cancellations, then references,
# each in order of arrival, as one whole number.
def _place(feed: int, order: str) -> str:
    return f"shiftleft(cast({feed} AS bigint), 60) + {order}"


def contract_ledger(rows: DataFrame, carry: list[str] = ALL) -> DataFrame:
    """One row per contract number, or per source id where the number is blank.

    ``carry`` names the columns kept on each side; narrower rows make a cheaper shuffle.
    ``w`` is the non-cancelled side, or the written reference when there is none; ``k`` is the
    cancelled side. ``w_place`` and ``k_place`` are the rows' places in the transaction list.
    """
    newest = "max_by(doc, struct(snapshot_ts, ingest_ord, source_id))"
    sides = (
        rows.selectExpr(
            "feed",
            "contract_number",
            "coalesce(nullif(contract_number, ''), source_id) AS ledger_key",
            "snapshot_ts",
            "ingest_ord",
            "source_id",
            f"struct({', '.join(dict.fromkeys(['snapshot_ts', 'transaction_type', *carry]))}) AS doc",
        )
        .groupBy("ledger_key")
        .agg(
            F.max("contract_number").alias("contract_number"),
            F.expr(f"{newest} FILTER (WHERE feed = 0) AS c"),
            F.expr(f"{newest} FILTER (WHERE feed = 1) AS x"),
            F.expr("min_by(doc, struct(ingest_ord, source_id)) FILTER (WHERE feed = 2) AS r"),
            F.expr("min(ingest_ord) FILTER (WHERE feed = 0) AS c_ord"),
            F.expr("min(ingest_ord) FILTER (WHERE feed = 1) AS x_ord"),
            F.expr("min(ingest_ord) FILTER (WHERE feed = 2) AS r_ord"),
        )
    )
    # Rows of one number and type are one transaction; without a number the source id alone
    # counts. The newer snapshot stays, at the place of the first.
    merged = sides.selectExpr(
        "*",
        "contract_number = '' AS is_blank",
        "c IS NOT NULL AND c.transaction_type = 'Cancellation' AS c_cancels",
        "c IS NOT NULL AND x IS NOT NULL"
        " AND (contract_number = '' OR c.transaction_type = 'Cancellation') AS is_same",
        "coalesce(x.snapshot_ts >= c.snapshot_ts, true) AS x_newer",
    ).selectExpr(
        "*",
        "c IS NOT NULL AND NOT c_cancels AND NOT (is_same AND x_newer) AS c_written",
        "x IS NOT NULL AND NOT (is_same AND NOT x_newer) AS x_stays",
        "r IS NOT NULL AND NOT is_blank AND (c IS NULL OR c_cancels) AS r_written",
    )
    return merged.selectExpr(
        "ledger_key",
        "contract_number",
        "CASE WHEN c_written THEN c WHEN r_written THEN r END AS w",
        "CASE WHEN x_stays THEN x WHEN c_cancels THEN c END AS k",
        f"CASE WHEN c_written THEN {_place(0, 'c_ord')}"
        f" WHEN r_written THEN {_place(2, 'r_ord')} END AS w_place",
        f"CASE WHEN x_stays AND NOT is_same THEN {_place(1, 'x_ord')}"
        f" WHEN x_stays OR c_cancels THEN {_place(0, 'c_ord')} END AS k_place",
    )


# Whether the newest state of the contract is its cancelled side; the later listed wins ties.
CANCEL_IS_LATEST = (
    "(k IS NOT NULL AND (w IS NULL OR k.snapshot_ts > w.snapshot_ts"
    " OR (k.snapshot_ts = w.snapshot_ts AND k_place > w_place)))"
)


def schedule_factor(effective: str, has_schedule: str, schedule: str, end: str) -> str:
    """Earned share at ``end``: 0 before the effective month, 1 where the curve has no value."""
    elapsed = cal.elapsed_months(effective, end)
    one = f"cast(1 AS {s.FACTOR})"
    return (
        f"CASE WHEN {has_schedule} AND {effective} IS NOT NULL THEN"
        f" CASE WHEN {effective} > {end} THEN cast(0 AS {s.FACTOR})"
        f" ELSE coalesce({schedule}[{elapsed}], {one}) END ELSE {one} END"
    )


def earned(written: str, cancelled: str, factor: str) -> str:
    """Reserve earned on one contract: its net amount once cancelled, else its factor's share."""
    return (
        f"CASE WHEN {cancelled} > 0 AND {written} > 0"
        f" THEN cast(greatest({written} - {cancelled}, 0) AS {s.EARNED})"
        f" WHEN {written} > 0 THEN cast(cast({written} AS {s.MONEY}) * {factor} AS {s.EARNED})"
        f" ELSE cast(0 AS {s.EARNED}) END"
    )


def contract_transactions(ledger: DataFrame, cfg: ReportConfig) -> DataFrame:
    """The transaction list: a row per contract side with its earned reserve and its place.

    The earned reserve covers the whole history of the contract up to the reporting end. Rows
    without a contract number earn nothing here and have no latest state.
    """
    end = cal.sql_date(cal.reporting_end(cfg))
    fields = [f.name for f in ledger.schema["w"].dataType.fields]
    carries_amounts = {"reserve_amount", "earning_schedule"} <= set(fields)
    late = ledger.selectExpr("*", f"{CANCEL_IS_LATEST} AS late")
    value = f"cast(0 AS {s.MONEY})"
    if carries_amounts:
        factor = (
            f"CASE WHEN w.contract_status = 'E' THEN cast(1 AS {s.FACTOR}) ELSE "
            + schedule_factor("w.effective_date", "w.has_schedule", "w.earning_schedule", end)
            + " END"
        )
        rule = earned("w.reserve_amount", "coalesce(abs(k.reserve_amount), 0)", factor)
        value = f"cast(CASE WHEN contract_number <> '' THEN {rule} ELSE 0 END AS {s.MONEY})"

    def side(name: str, earned_value: str, latest: str) -> DataFrame:
        return late.where(f"{name}.transaction_type IS NOT NULL").selectExpr(
            "ledger_key",
            "contract_number",
            *[f"{name}.{f} AS {f}" for f in fields],
            f"{earned_value} AS earned_reserve_amount",
            f"{name}_place AS place",
            f"contract_number <> '' AND {latest} AS is_latest_state",
        )

    # a select per side, so that a scan of the ledger reads no other fields than its user asks for
    return side("w", value, "NOT late").unionByName(side("k", f"cast(0 AS {s.MONEY})", "late"))


def number_within(
    df: DataFrame, groups: list[str], order: str, tie: list[str], width: int = 1_000_000
) -> DataFrame:
    """Position ``n`` (1, 2, …) of each row in its group by a whole-number order column.

    A group of any size is cut into slices of the order column. Slices are numbered on their
    own, and the rows of earlier slices are added from a table of slice sizes, so no task ever
    sorts a whole group.
    """
    sliced = df.withColumn("_slice", F.expr(f"{order} div {width}"))
    sizes = sliced.groupBy(*groups, "_slice").agg(F.count("*").alias("_rows"))
    before = W.partitionBy(*groups).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        sizes.withColumn("_offset", F.sum("_rows").over(before))
        .where("_offset > 0")
        .select(*groups, "_slice", "_offset")
    )
    here = W.partitionBy(*groups, "_slice").orderBy(order, *tie)
    return (
        sliced.withColumn("_n", F.row_number().over(here))
        .join(offsets, [*groups, "_slice"], "left")
        .withColumn("n", F.expr("_n + coalesce(_offset, 0)"))
        .drop("_slice", "_n", "_offset")
    )


_SHARES = 16_384


def dedupe_claims(claims: DataFrame, width: int = 1_000_000) -> DataFrame:
    """Newest line of each payment.

    The same payment key twice on one scrape day means two payments; the n-th of a day is
    matched with the n-th of other days, and the newest snapshot of each is kept. ``place`` is
    where the payment was first seen.

    Lines are shuffled once, by key. Those of a share of the keys that holds more than ``width`` lines
    are numbered by ``number_within`` instead, where no task sorts a whole group.
    """
    keyed = claims.selectExpr(
        "*",
        f"{s.or_else('payment_key', 'source_id')} AS _key",
        "cast(snapshot_ts AS date) AS _day",
    ).withColumn("_share", F.expr(f"pmod(xxhash64(_key), {_SHARES})"))
    # counted by shares of the keys: a row per share and task is shuffled, not one per key
    hot = F.broadcast(keyed.groupBy("_share").count().where(f"count > {width}").select("_share"))
    few = keyed.join(hot, "_share", "left_anti").repartition("_key")
    here = W.partitionBy("_key", "_day").orderBy("ingest_ord", "source_id")
    numbered = few.withColumn("n", F.row_number().over(here))
    many = number_within(keyed.join(hot, "_share", "left_semi"), ["_key", "_day"], "ingest_ord", ["source_id"], width)
    return _newest_payments(numbered, claims.columns).unionByName(_newest_payments(many, claims.columns))


def _newest_payments(numbered: DataFrame, fields: list[str]) -> DataFrame:
    return (
        numbered.selectExpr("_key", "n", "ingest_ord", f"struct({', '.join(fields)}) AS line")
        .groupBy("_key", "n")
        .agg(
            F.expr("max_by(line, struct(line.snapshot_ts, ingest_ord, line.source_id)) AS line"),
            F.min("ingest_ord").alias("place"),
        )
        .selectExpr("line.*", "n AS occurrence", "place")
    )


def contract_lookup(ledger: DataFrame, fields: list[str] = NAMES) -> DataFrame:
    """Last new-business row per contract number; all blank numbers share one row."""
    return _one_per_number(ledger.where("w.transaction_type = 'NewBusiness'"), fields)


def written_lookup(ledger: DataFrame, fields: list[str] = NAMES) -> DataFrame:
    """Last row of any type but cancellation per contract number, blank numbers left out."""
    numbered = ledger.where("w.transaction_type IS NOT NULL AND contract_number <> ''")
    return numbered.selectExpr("contract_number", f"struct({_of_w(fields)}) AS found")


def _of_w(fields: list[str]) -> str:
    return ", ".join(f"w.{f} AS {f}" for f in fields)


def _one_per_number(df: DataFrame, fields: list[str]) -> DataFrame:
    """A row per contract number.

    A numbered contract has one ledger row already and passes through; only the blank ones are
    aggregated, and combined before their shuffle.
    """
    rows = df.selectExpr("contract_number", f"struct({_of_w(fields)}) AS found", "w_place")
    blank = rows.where("contract_number = ''").groupBy("contract_number")
    return (
        rows.where("contract_number <> ''")
        .drop("w_place")
        .unionByName(blank.agg(F.max_by("found", "w_place").alias("found")))
    )


def with_lookup(claims: DataFrame, lookup: DataFrame) -> DataFrame:
    """Left join on the contract number.

    All lines without a number meet one lookup row. They are split off and that row is broadcast to
    them, so a feed with many blank numbers makes no hot key.
    """
    numbered = claims.where("contract_number <> ''").join(
        lookup.where("contract_number <> ''"), "contract_number", "left"
    )
    blank = F.broadcast(lookup.where("contract_number = ''"))  # one row: lookups are per number
    rest = claims.where("contract_number = ''").join(blank, "contract_number", "left")
    return numbered.unionByName(rest)


def effective_lookup(transactions: DataFrame) -> DataFrame:
    """First listed effective date of each contract number."""
    return (
        transactions.where("effective_date IS NOT NULL")
        .groupBy("contract_number")
        .agg(F.min_by("effective_date", "place").alias("effective_date"))
    )


def sql_service_contracts(rows: DataFrame) -> DataFrame:
    """Newest row per (contract, type) straight from the feeds, blank numbers left out."""
    return latest_by(
        rows.where("contract_number <> '' AND feed < 2"),
        ["contract_number", "transaction_type"],
        ["snapshot_ts", "feed", "ingest_ord"],
    )


def sql_service_claims(rows: DataFrame) -> DataFrame:
    """Newest line per payment key, repeats of a day merged."""
    keyed = rows.selectExpr(
        "*", "coalesce(nullif(payment_key, ''), claim_number, source_id) AS _key"
    )
    return latest_by(keyed, ["_key"], ["snapshot_ts", "ingest_ord", "source_id"]).drop("_key")


def entity_keys(dimensions: DataFrame) -> DataFrame:
    """(dim, entity, key): the codes and names, in upper case, under which an entity has rows.

    Dealers are entities under their code and under their display name, agents under their code.
    Each has the rows of its code and of its display name. A display name that several dealers
    share stands for the last of them in the ranking.
    """
    known = dimensions.where("dim <> 'product' AND period_id = 'inception'").selectExpr(
        "dim", "dim_value", "coalesce(display_name, '') AS display_name",
        "struct(-net_admin AS a, -net_reserve AS r, dim_value AS v) AS place",
    )
    codes = known.selectExpr("dim", "dim_value AS entity", "explode(array(dim_value, display_name)) AS key")
    names = (
        known.where("dim = 'dealer' AND display_name <> ''")
        .groupBy("dim", F.col("display_name").alias("entity"))
        .agg(F.max_by("dim_value", "place").alias("code"))
        .selectExpr("dim", "entity", "explode(array(entity, code)) AS key")
    )
    return (
        codes.unionByName(names)
        .selectExpr("dim", "entity", f"upper({s.trimmed('key')}) AS key")
        .where("key <> ''")
        .distinct()
    )


def entity_rows(rows: DataFrame, keys: DataFrame, dim: str, code: str, name: str) -> DataFrame:
    """Each row once for every entity it belongs to by its code or by its name.

    The entities of one key are gathered before the join, so that a row found by both its code and
    its name is not repeated and nothing has to be made distinct afterwards.
    """
    own = keys.where(F.col("dim") == dim).groupBy("key").agg(F.collect_set("entity").alias("entities"))
    for i, column in enumerate((code, name)):
        side = own.select(F.col("key").alias(f"key_{i}"), F.col("entities").alias(f"entities_{i}"))
        rows = rows.join(side, F.expr(f"upper({s.trimmed(column)}) = key_{i}"), "left")
    both = "array_union(coalesce(entities_0, array()), coalesce(entities_1, array()))"
    return rows.selectExpr("*", f"explode({both}) AS entity").drop(
        "key_0", "key_1", "entities_0", "entities_1"
    )


def entity_sums(
    rows: DataFrame, keys: DataFrame, dim: str, code: str, name: str, groups: list[str], sums: list[str],
    firsts: list[str] = (),
) -> DataFrame:
    """``sums`` and smallest ``firsts`` over the ``entity_rows`` of each entity and group.

    A row has a key of its code and one of its name. Sums are made of each key and of each pair of keys; an
    entity's sum is that of its keys less that of the pairs it has both keys of, whose rows were counted twice.
    A name that very many entities share thus costs them a row per group each, not all rows of the name.
    """
    total = [F.expr(f"cast(sum({c}) AS {t}) AS {c}") for c, t in rows.dtypes if c in sums]
    least = [F.min(c).alias(c) for c in firsts]
    keyed = rows.selectExpr(
        f"upper({s.trimmed(code)}) AS key_0", f"upper({s.trimmed(name)}) AS key_1", *groups, *sums, *firsts
    )
    of_key = (
        keyed.selectExpr(
            "explode(array_distinct(array_compact(array(key_0, key_1)))) AS key", *groups, *sums, *firsts
        )
        .groupBy("key", *groups)
        .agg(*total, *least)
    )
    of_pair = (
        keyed.where("key_0 <> key_1")
        .selectExpr("least(key_0, key_1) AS key", "greatest(key_0, key_1) AS other", *groups, *sums)
        .groupBy("key", "other", *groups)
        .agg(*total)
        .selectExpr("key", "other", *groups, *[f"-{c} AS {c}" for c in sums])
    )
    own = keys.where(F.col("dim") == dim).select("entity", "key")
    both = own.join(own.select("entity", F.col("key").alias("other")), "entity").where("key < other")
    counted = of_key.join(own, "key").select("entity", *groups, *sums, *firsts)
    twice = of_pair.join(both, ["key", "other"]).select("entity", *groups, *sums)
    return counted.unionByName(twice, allowMissingColumns=True).groupBy("entity", *groups).agg(*total, *least)


def _key_terms(keys: str) -> str:
    """Signed sets of keys whose sum over the sets inside an entity's keys is 1 if it has any of ``keys``, an array
    of at most two, and else 0: each key, less both together (SQL text)."""
    return (
        f"concat(transform({keys}, a -> struct(array(a) AS k, 1 AS s)),"
        f" if(size({keys}) = 2, array(struct(array_sort({keys}) AS k, -1 AS s)), array()))"
    )


def _both_terms(one: str, other: str) -> str:
    """Signed sets that tell whether an entity passes both (SQL text)."""
    return (
        f"flatten(transform({one}, x -> transform({other}, y ->"
        " struct(array_sort(array_union(x.k, y.k)) AS k, x.s * y.s AS s))))"
    )


def _key_array(code: str, name: str) -> str:
    keys = ", ".join(f"nullif(upper({s.trimmed(c)}), '')" for c in (code, name))
    return f"array_distinct(array_compact(array({keys})))"


def entity_claim_products(
    claims: DataFrame, ledger: DataFrame, keys: DataFrame, dim: str, code: str, name: str, contract_code: str,
    skip_cancelled: bool,
) -> DataFrame:
    """``claims_paid`` per entity and product, as of ``claim_products`` of its ``entity_rows``.

    Whether a contract's product counts depends on the entity: the contract must be among its rows too. So all
    claims are summed under their own product first, by ``entity_sums``. What moves is then summed by the sets of
    keys that an entity must have for it, with signs, and only these sums meet the entities.
    """
    own = s.or_else("product", "'Standard'")
    lines = claims.selectExpr(
        "*", f"{own} AS claim_product", f"cast(paid_amount AS {s.MONEY_SUM}) AS paid", "1L AS n"
    )
    sums, groups = ["paid", "n"], ["claim_product"]
    still = entity_sums(lines, keys, dim, code, name, groups, sums)

    kept = " AND {x}.transaction_type <> 'Cancellation'" if skip_cancelled else ""
    side = lambda x: (
        f"CASE WHEN {x}.transaction_type IS NOT NULL{kept.format(x=x)} THEN named_struct('keys',"
        f" {_key_array(f'{x}.{contract_code}', f'{x}.{name}')}, 'product', {x}.product, 'place', {x}_place) END AS {x}"
    )
    sides = ledger.where("contract_number <> ''").selectExpr("contract_number", side("w"), side("k"))
    known = keys.where(F.col("dim") == dim).select("entity", "key")
    pairs = known.join(known.select("entity", F.col("key").alias("other")), "entity").select("key", "other").distinct()
    met = (
        lines.where("contract_number <> ''")
        .join(sides.where("w IS NOT NULL OR k IS NOT NULL"), "contract_number")
        .selectExpr(
            f"{_key_array(code, name)} AS c", "w.keys AS w", "k.keys AS k", "claim_product", *sums,
            "coalesce(nullif(w.product, ''), claim_product) AS w_product",
            "coalesce(nullif(k.product, ''), claim_product) AS k_product", "w.place > k.place AS w_later",
        )
        # rows of one kind are summed before anything is made of them
        .groupBy("c", "w", "k", "claim_product", "w_product", "k_product", "w_later")
        .agg(*[F.expr(f"cast(sum({c}) AS {t}) AS {c}") for c, t in lines.dtypes if c in sums])
        .withColumn("id", F.expr("struct(c, w, k, claim_product, w_product, k_product, w_later)"))
    )
    # of these only such with a key of the claim and one of the contract that some entity has both of
    reached = (
        met.selectExpr("id", "explode(c) AS key", "concat(coalesce(w, array()), coalesce(k, array())) AS others")
        .selectExpr("id", "key", "explode(array_distinct(others)) AS other")
        .join(pairs, ["key", "other"], "left_semi")
        .select("id")
        .distinct()
    )
    with_w = _both_terms(_key_terms("c"), _key_terms("coalesce(w, array())"))
    with_k = _both_terms(_key_terms("c"), _key_terms("coalesce(k, array())"))
    with_both = _both_terms(with_w, _key_terms("coalesce(k, array())"))
    # under both the later side counts: each side, less the earlier one where there are both
    moves = [
        (with_w, 1, "w_product"), (with_w, -1, "claim_product"),
        (with_k, 1, "k_product"), (with_k, -1, "claim_product"),
        (with_both, -1, "if(w_later, k_product, w_product)"), (with_both, 1, "claim_product"),
    ]
    parts = ", ".join(
        f"transform({terms}, t -> struct(t.k AS keys, t.s * {sign} AS sign, {product} AS claim_product))"
        for terms, sign, product in moves
    )
    moved = (
        met.join(reached, "id", "left_semi")
        .selectExpr(f"inline(concat({parts}))", *sums)
        .groupBy("keys", "claim_product")
        .agg(*[F.expr(f"cast(sum(sign * {c}) AS {t}) AS {c}") for c, t in lines.dtypes if c in sums])
        .where("n <> 0 OR paid <> 0")
    )
    sets = (
        known.groupBy("entity")
        .agg(F.array_sort(F.collect_set("key")).alias("all"))  # three keys at most (entity_keys)
        .selectExpr("entity", "all", "explode(sequence(1, cast(shiftleft(1, size(all)) - 1 AS int))) AS bits")
        .selectExpr("entity", "filter(all, (x, i) -> (shiftright(bits, i) & 1) = 1) AS keys")
    )
    total = [F.expr(f"cast(sum({c}) AS {t}) AS {c}") for c, t in lines.dtypes if c in sums]
    return (
        still.unionByName(moved.join(sets, "keys").select("entity", *groups, *sums))
        .groupBy("entity", *groups)
        .agg(*total)
        .where("n > 0")
        .selectExpr("entity", "claim_product AS product", "paid AS claims_paid")
    )


def entity_fanout(df: DataFrame, columns: list[str]) -> DataFrame:
    """A row for each entity it is known under, by code or by name, in upper case."""
    names = ", ".join(f"upper(trim({c}))" for c in columns)
    return df.selectExpr(
        "*", f"explode(filter(array_distinct(array({names})), n -> n <> '')) AS entity"
    )
