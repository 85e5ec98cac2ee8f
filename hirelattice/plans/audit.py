"""From a check catalogue to an audit table.

``audit_fused`` is the form to run. Per key domain (a parent table and its key), children and
parent contribute narrow counter rows to a single ``groupBy`` on the key, so duplicates, orphans
and matched totals share one shuffle, nothing is joined, and a hot or missing key shrinks to one
row per task before it moves. A table is scanned once: each of its rows unfolds into a row for every domain it feeds, and
the rows of all domains meet in one aggregate by domain and key. Plain counts and totals of a table ride along in a domain that
reads the table anyway; a table in no domain has one without a key.

``store_counters`` keeps the counters per key, and ``audit_stored`` audits from them: a load adds its own rows' counters, and the audit's
cost follows the number of keys, not of rows.

``audit_by_branch`` answers each check on its own with joins and scalar subqueries. It is
the plain reading of the catalogue, kept for single checks and to verify the fused form.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, DoubleType, FloatType, StringType, StructType, TimestampType

from ..functions import exact_total
from ..functions.numbers import join_parts, total_parts, total_struct_text
from ..operators.matching import orphan_count
from ..operators.metrics import monthly_totals, row_count
from ..sources.tables import append_table, bucket_count, replace_partitions, replace_table
from .checks import Check, Constant, Measure, MatchedTotal, MonthlyTotal, Rows, Surplus, Total, Unmatched

# Fixed value: differences below this pass.
TOLERANCE = 0.005
# A fact is an exact part (counts, and amounts that are whole cents) and the total of all other
# amounts, NULL if there are none, so that large totals are compared before they lose their cents.
EXACT = "decimal(38,4)"
FACT_TYPE = f"struct<exact:{EXACT},rest:double>"

Tables = Mapping[str, DataFrame]


def score(checks: DataFrame) -> DataFrame:
    """Difference and status per check row. A missing difference is a FAIL.

    ``expected`` and ``actual`` are facts, or plain numbers.
    """
    if isinstance(checks.schema["expected"].dataType, StructType):
        expected, actual = F.col("expected"), F.col("actual")
        whole = actual["rest"].isNull() & expected["rest"].isNull()
        exact = (actual["exact"] - expected["exact"]).cast("double")
        difference = F.when(whole, exact).otherwise(_number(actual) - _number(expected))
        checks = checks.select(
            "check_type", "check_name", "description", _number(expected).alias("expected"), _number(actual).alias("actual"),
            difference.alias("difference"),
        )
    else:
        checks = checks.withColumn("difference", F.col("actual") - F.col("expected"))
    difference = F.col("difference")
    passed = F.abs(difference) < F.lit(TOLERANCE)  # NaN counts as larger than any number
    return checks.select(
        "check_type",
        "check_name",
        "description",
        F.col("expected").cast("double").alias("expected"),
        F.col("actual").cast("double").alias("actual"),
        difference.cast("double").alias("difference"),
        F.when(passed, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
    )


def _number(fact: Column) -> Column:
    """A fact as one DOUBLE."""
    exact = fact["exact"].cast("double")
    return F.when(fact["rest"].isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + fact["rest"])


def _counted(value: str) -> str:
    """SQL text of a count as a fact."""
    return f"named_struct('exact', CAST({value} AS {EXACT}), 'rest', CAST(NULL AS DOUBLE))"


def stamp_checked(audit: DataFrame) -> DataFrame:
    """Add the instant of the audit, the same for all rows."""
    return audit.withColumn("checked_at", F.current_timestamp())


# --- one check at a time ----------------------------------------------------------------


def _filtered(df: DataFrame, where: str | None) -> DataFrame:
    return df.where(where) if where is not None else df


def measure_frame(measure: Measure, tables: Tables) -> DataFrame:
    """One row, one column: the value of a measure, by joins and plain aggregates."""
    match measure:
        case Rows(table, where):
            return _filtered(tables[table], where).agg(row_count())
        case Total(table, amount, where):
            return _filtered(tables[table], where).agg(F.expr(total_struct_text(amount)))
        case MonthlyTotal(table, amount, day):
            months = monthly_totals(tables[table], day, amount, month="month", total="total")
            return months.where(F.col("month").isNotNull()).agg(F.expr(total_struct_text("total")))
        case Surplus(table, key):
            return tables[table].agg(row_count() - F.count_distinct(F.col(key)))
        case Unmatched(child, keys, parent, parent_keys, where, witness):
            parents = _filtered(tables[parent], where)
            missing = orphan_count(tables[child], parents, keys, parent_keys)
            if witness is None:
                return missing
            unvouched = _pairs(tables[child], keys, parents.where(F.col(witness).isNull()), parent_keys)
            rows = unvouched.agg(F.coalesce(F.sum(F.col("_rows") * F.col("_parents")), F.lit(0)).alias("orphans"))
            return missing.unionByName(rows).agg(F.sum("orphans"))
        case MatchedTotal(child, amount, keys, parent, parent_keys, where):
            parents = _filtered(tables[parent], where)
            per_key = _pairs(tables[child], keys, parents, parent_keys, amount)
            return per_key.agg(F.expr(total_struct_text("_total * _parents")))
    raise TypeError(f"no such measure: {measure!r}")


def _pairs(child: DataFrame, keys, parents: DataFrame, parent_keys, amount: str | None = None) -> DataFrame:
    """Per key both sides share: child rows (and total), parent rows. One row per key."""
    sums = [row_count().alias("_rows")]
    if amount is not None:
        sums.append(exact_total(amount).alias("_total"))
    left = child.groupBy(*keys).agg(*sums)
    renamed = parents.select(*[F.col(p).alias(k) for k, p in zip(keys, parent_keys)])
    right = renamed.groupBy(*keys).agg(row_count().alias("_parents"))
    return left.join(right, list(keys))


def _value(measure: Measure, tables: Tables) -> Column:
    if isinstance(measure, Constant):
        return F.expr(_counted(str(measure.value)))
    frame = measure_frame(measure, tables)
    if not isinstance(frame.schema.fields[0].dataType, StructType):
        frame = frame.selectExpr(_counted(f"`{frame.columns[0]}`"))
    return frame.scalar()


def audit_by_branch(checks: Sequence[Check], tables: Tables) -> DataFrame:
    """One constant row of scalar subqueries per check, all rows unioned and scored."""
    one = SparkSession.active().range(1, numPartitions=1)
    branches = [
        one.select(
            F.lit(c.check_type).alias("check_type"),
            F.lit(c.check_name).alias("check_name"),
            F.lit(c.description).alias("description"),
            _value(c.expected, tables).alias("expected"),
            _value(c.actual, tables).alias("actual"),
        )
        for c in checks
    ]
    return score(reduce(DataFrame.unionByName, branches))


# --- the whole catalogue at once ----------------------------------------------------------


_Part = tuple[str, tuple[str, ...]]  # a table and its key columns


@dataclass
class _Domain:
    """Counters that tables add to the rows of one parent key.

    Everything is SQL text. ``parts`` holds, per table and its key columns, each counter's per-row value and the condition
    for a row to matter to it (None: every row does). Counters are numbered columns, whole (n0, n1, ...) or not (r0, ...);
    domains use the same columns, so they can share an aggregate. ``facts`` holds aggregates over one row of counters per key.
    """

    number: int
    keys: tuple[str, ...]
    parts: dict[_Part, dict[str, tuple[str, str | None]]] = field(default_factory=dict)
    facts: dict[str, str] = field(default_factory=dict)
    _names: dict[tuple, str] = field(default_factory=dict)

    def has_key(self) -> str:
        return " AND ".join(f"k{i} IS NOT NULL" for i in range(len(self.keys)))

    def sum(self, value: str) -> str:
        return f"sum({value}) FILTER (WHERE domain = {self.number})"

    def counter(self, table: str, keys: tuple[str, ...], value: str, condition: str | None, kind: str = "n") -> str:
        """Register a per-row value once; the name holds its sum (NULL when absent)."""
        taken = sum(name[0] == kind for name in self._names.values())
        name = self._names.setdefault((table, keys, value), f"{kind}{taken}")
        self.parts.setdefault((table, keys), {})[name] = (value, condition)
        return name

    def total(self, table: str, keys: tuple[str, ...], amount: str) -> tuple[str, str, str]:
        """The counters of an amount's high and low parts and of its rest."""
        there = f"({amount}) IS NOT NULL"
        high, low, rest = total_parts(amount)
        return (
            self.counter(table, keys, high, there), self.counter(table, keys, low, there),
            self.counter(table, keys, rest, there, "r"),
        )

    def count(self, table: str, keys: tuple[str, ...], *conditions: str | None) -> str:
        kept = " AND ".join(f"({c})" for c in conditions if c is not None)
        one = f"CASE WHEN {kept} THEN 1L END" if kept else "1L"
        return f"coalesce({self.counter(table, keys, one, kept or None)}, 0L)"

    def rows_that_count(self, table: str, keys: tuple[str, ...]) -> str | None:
        """Condition under which a row adds to any counter; None when every row does."""
        conditions = list(dict.fromkeys(condition for _, condition in self.parts[table, keys].values()))
        return None if None in conditions else " OR ".join(f"({c})" for c in conditions)


def _keyed_fact(measure: Measure, domain: _Domain) -> str:
    """The measure as an aggregate over the domain's counters."""
    has_key = domain.has_key()
    match measure:
        case Surplus(table, key):
            rows = domain.count(table, (key,))
            surplus = f"CASE WHEN {has_key} AND {rows} > 0 THEN {rows} - 1 ELSE {rows} END"
            return _counted(f"coalesce({domain.sum(surplus)}, 0)")
        case Unmatched(child, keys, parent, parent_keys, where, witness):
            rows = domain.count(child, keys)
            parents = domain.count(parent, parent_keys, where)
            unvouched = "0L"
            if witness is not None:
                unvouched = domain.count(parent, parent_keys, where, f"{witness} IS NULL")
            weight = f"CASE WHEN NOT ({has_key}) OR {parents} = 0 THEN 1L ELSE {unvouched} END"
            return _counted(f"coalesce({domain.sum(f'{rows} * {weight}')}, 0)")
        case MatchedTotal(child, amount, keys, parent, parent_keys, where):
            high, low, rest = domain.total(child, keys, amount)
            parents = domain.count(parent, parent_keys, where)
            matched = f"{has_key} AND {parents} > 0"
            exact = f"CASE WHEN {matched} THEN CAST({join_parts(high, low)} AS DECIMAL(28,4)) * {parents} END"
            other = f"CASE WHEN {matched} THEN {rest} * {parents} END"
            return f"named_struct('exact', CAST({domain.sum(exact)} AS {EXACT}), 'rest', {domain.sum(other)})"
    raise TypeError(f"not a keyed measure: {measure!r}")


def _riding_fact(measure: Measure, domain: _Domain, keys: tuple[str, ...]) -> str:
    """A measure that needs no key, as an aggregate over a domain that reads its table by ``keys``. Filters become conditions."""
    match measure:
        case Rows(table, where):
            return _counted(f"coalesce({domain.sum(domain.count(table, keys, where))}, 0)")
        case Total(table, amount, where):
            chosen = amount if where is None else f"CASE WHEN {where} THEN {amount} END"
        case MonthlyTotal(table, amount, day):
            # Adding up months is adding up their rows; only dated rows have a month.
            chosen = f"CASE WHEN {day} IS NOT NULL THEN {amount} END"
        case _:
            raise TypeError(f"no such measure: {measure!r}")
    high, low, rest = domain.total(table, keys, chosen)
    return f"named_struct('exact', {join_parts(domain.sum(high), domain.sum(low))}, 'rest', {domain.sum(rest)})"


def _text(value: str) -> str:
    """``value`` as a SQL text literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _key_text(key: str, kind: DataType) -> str:
    """A key as text, equal exactly where the keys are."""
    match kind:
        case StringType():
            return key
        case FloatType() | DoubleType():
            return f"CAST({key} + 0 AS STRING)"  # one zero
        case TimestampType():
            return f"CAST(unix_micros({key}) AS STRING)"
        case BinaryType():
            return f"hex({key})"
        case _:
            return f"CAST({key} AS STRING)"


def _key_kinds(domain: _Domain, tables: Tables) -> list[DataType]:
    """The type in which the keys of a domain's parts are compared, as a union of them has it."""
    names = [f"k{i}" for i in range(len(domain.keys))]
    keys = [tables[table].selectExpr(*[f"{k} AS {n}" for k, n in zip(part, names)]) for table, part in domain.parts]
    return [f.dataType for f in reduce(DataFrame.union, keys).schema] if names else []


def _unfolded(table: str, domains: Sequence[_Domain], kinds: Mapping[int, list[DataType]], columns: Sequence[str], tables: Tables) -> DataFrame:
    """One scan of a table: each row as a row for every domain it feeds, NULL in the columns of others.

    Rows that count nowhere are left out by the scan's filter.
    """
    rows, conditions = [], []
    for domain in domains:
        for part, counters in domain.parts.items():
            if part[0] != table:
                continue
            condition = domain.rows_that_count(*part)
            conditions.append(condition)
            number = f"{domain.number}" if condition is None else f"CASE WHEN {condition} THEN {domain.number} END"
            values = {"domain": f"CAST({number} AS INT)"}
            for i, (key, kind) in enumerate(zip(part[1], kinds[domain.number])):
                values[f"k{i}"] = _key_text(f"CAST({key} AS {kind.simpleString()})", kind)
            for name in columns[1:]:
                kind = {"k": "STRING", "n": "BIGINT", "r": "DOUBLE"}[name[0]]
                values.setdefault(name, f"CAST({counters[name][0] if name in counters else 'NULL'} AS {kind})")
            rows.append(", ".join(f"{values[c]} AS {c}" for c in columns))
    kept = None if None in conditions else " OR ".join(f"({c})" for c in conditions)
    scanned = _filtered(tables[table], kept)
    if len(rows) == 1:
        return scanned.selectExpr(f"inline(array(struct({rows[0]})))")
    unfolded = scanned.selectExpr(f"inline(array({', '.join(f'struct({r})' for r in rows)}))")
    return unfolded.where("domain IS NOT NULL") if any(conditions) else unfolded


def _domains(measures: Mapping[Measure, str]) -> list[_Domain]:
    """The measures by domain; duplicates are counted in any domain the table feeds by that key, plain ones in any it feeds at all."""
    domains: dict[_Part, _Domain] = {}

    def domain_of(table: str, keys: tuple[str, ...]) -> _Domain:
        return domains.setdefault((table, keys), _Domain(len(domains), keys))

    def feeding(table: str, keys: tuple[str, ...] | None = None) -> tuple[_Domain, tuple[str, ...]] | None:
        found = ((d, part) for d in domains.values() for name, part in d.parts if name == table and keys in (None, part))
        return next(found, None)

    keyed = (Unmatched, MatchedTotal)
    for measure, name in measures.items():
        if isinstance(measure, keyed):
            domain = domain_of(measure.parent, measure.parent_keys)
            domain.facts[name] = _keyed_fact(measure, domain)
    for measure, name in measures.items():
        if isinstance(measure, Surplus):
            domain, _ = feeding(measure.table, (measure.key,)) or (domain_of(measure.table, (measure.key,)), None)
            domain.facts[name] = _keyed_fact(measure, domain)
    for measure, name in measures.items():
        if not isinstance(measure, (*keyed, Surplus)):
            domain, keys = feeding(measure.table) or (domain_of(measure.table, ()), ())
            domain.facts[name] = _riding_fact(measure, domain, keys)
    return list(domains.values())


@dataclass(frozen=True)
class _Plan:
    """A compiled catalogue: its domains, the columns of their shared rows, and the checks over their facts."""

    domains: list[_Domain]
    keys: list[str]
    counters: list[str]
    checks: str

    @classmethod
    def of(cls, checks: Sequence[Check]) -> _Plan:
        used = (m for c in checks for m in (c.expected, c.actual) if not isinstance(m, Constant))
        names = {measure: f"fact_{i}" for i, measure in enumerate(dict.fromkeys(used))}
        rows = [
            f"struct({_text(c.check_type)} AS check_type, {_text(c.check_name)} AS check_name,"
            f" {_text(c.description)} AS description, {_fact(c.expected, names)} AS expected,"
            f" {_fact(c.actual, names)} AS actual)"
            for c in checks
        ]
        domains = _domains(names)
        counters = {name for d in domains for part in d.parts.values() for name in part}
        keys = [f"k{i}" for i in range(max((len(d.keys) for d in domains), default=0))]
        return cls(domains, keys, sorted(counters, key=lambda n: (n[0], int(n[1:]))), f"inline(array({', '.join(rows)}))")

    def sources(self) -> list[str]:
        return list(dict.fromkeys(table for d in self.domains for table, _ in d.parts))

    def unfolded(self, tables: Tables, sources: Sequence[str]) -> list[DataFrame]:
        kinds = {d.number: _key_kinds(d, tables) for d in self.domains}
        return [_unfolded(t, self.domains, kinds, ["domain", *self.keys, *self.counters], tables) for t in sources]

    def per_key(self, rows: DataFrame, *more: str) -> DataFrame:
        return rows.groupBy(*more, "domain", *self.keys).agg(*[F.expr(f"sum({c}) AS {c}") for c in self.counters])

    def scored(self, per_key: DataFrame) -> DataFrame:
        facts = [F.expr(f"CAST({fact} AS {FACT_TYPE}) AS {name}") for d in self.domains for name, fact in d.facts.items()]
        return score(per_key.agg(*facts).selectExpr(self.checks))


def audit_fused(checks: Sequence[Check], tables: Tables) -> DataFrame:
    """All checks from one scan a table and one aggregate by domain and key, scored."""
    plan = _Plan.of(checks)
    if not plan.domains:
        return score(SparkSession.active().range(1, numPartitions=1).selectExpr(plan.checks))
    return plan.scored(plan.per_key(reduce(DataFrame.union, plan.unfolded(tables, plan.sources()))))


# --- counters that are kept ---------------------------------------------------------------

SOURCE = "source"
# Rows that sources give to a bucket: at most so many keys, which one task adds up in some 100 to 1,000 MB.
ROWS_A_BUCKET = 1 << 22


def store_counters(
    checks: Sequence[Check], tables: Tables, stored: str, buckets: int = 64, only: Sequence[str] | None = None, appended: bool = False,
) -> None:
    """Keep the catalogue's counters, one row per source table, domain and key, dealt to files by domain and key.

    ``only`` names the sources whose counters are put in place of the kept ones, as after a table is replaced; with
    ``appended`` the given tables hold new rows only, whose counters are added. A key that holds a third of a table's rows is one row
    here, so no file is larger than its keys. ``buckets`` is the least number of them: a first build counts its rows and takes as many as keep a
    bucket's keys within a task's memory, and later ones take what the table has. ``tables`` must have all sources of the catalogue, for their key types.
    """
    plan = _Plan.of(checks)
    sources = [s for s in plan.sources() if only is None or s in only]
    rows = [df.withColumn(SOURCE, F.lit(source)) for source, df in zip(sources, plan.unfolded(tables, sources), strict=True)]
    spread = ["domain", *plan.keys]
    if only is None and not appended:
        feeds = Counter(table for d in plan.domains for table, _ in d.parts)
        buckets = max(buckets, -(-sum(tables[s].count() * n for s, n in feeds.items()) // ROWS_A_BUCKET))
    else:
        buckets = bucket_count(SparkSession.active(), stored) or buckets
    counted = plan.per_key(reduce(DataFrame.union, rows), SOURCE).repartition(buckets, *spread)
    if only is None and not appended:
        replace_table(counted, stored, [SOURCE], (buckets, spread))
    elif appended:
        append_table(counted, stored)
    else:
        replace_partitions(counted, stored)


def audit_stored(checks: Sequence[Check], counters: DataFrame) -> DataFrame:
    """All checks from kept counters: no row of a source is read, and keys meet without a shuffle."""
    plan = _Plan.of(checks)
    return plan.scored(plan.per_key(counters))


def _fact(measure: Measure, names: Mapping[Measure, str]) -> str:
    if isinstance(measure, Constant):
        return _counted(str(measure.value))
    return names[measure]


class IntegrityError(RuntimeError):
    """Raised by the gate when a check does not pass."""


def assert_all_pass(audit: DataFrame) -> None:
    """Stop before a write when any check fails. Collects failing check rows only."""
    failing = audit.where(~F.col("status").eqNullSafe("PASS")).orderBy("check_type", "check_name").collect()
    if failing:
        lines = [f"{r.check_name}: expected {r.expected}, got {r.actual}" for r in failing]
        raise IntegrityError("; ".join(lines))
