"""Secret scans through a trigram index, with DataFrame functions only.

Each rule's regular expression is turned into a Boolean query over trigrams that
every match must hold (``trigram_query``). Postings (trigram, text key) are kept
for the trigrams of the rule set; a rule's candidates are the texts whose postings
satisfy its query; only those are searched with its expression. A rule without a
mandatory trigram is searched in every text.

A text's key is a 128-bit hash: equal texts share postings, and a collision could
only add a candidate. Matching is Java's ``find``: leftmost, non-overlapping.

Defined results: null text is empty (no span); repeated rows are scanned each; an
empty table gives no rows; spans are sorted by start, then by rule order; input
columns named ``spans`` are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

try:
    from re import _constants as rc
    from re import _parser as rp
except ImportError:  # before Python 3.11
    import sre_constants as rc
    import sre_parse as rp


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose group ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base rules, in their order.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    # A run of 16 or more is found at the start of its maximal run, as [0-9a-f]+ with a length test would.
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
# Further well-known key formats.
MORE_RULES = (
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

BLOCK = 128  # values of a running sum that are summed together
CUT = 256  # characters of the parts that a text is cut into while it is redacted
EXACT_LIMIT = 64  # strings that an exact set may hold while a query is derived

# A query is None (no mandatory trigram), ("has", t), ("and", [...]) or ("or", [...]).


def _both(kind: str, parts: list):
    parts = list(dict.fromkeys(p for p in parts if p is not None))
    return None if not parts else parts[0] if len(parts) == 1 else (kind, tuple(parts))


def _of_strings(strings: set[str]):
    """What holds in a text with one of ``strings``: all trigrams of one of them."""
    if any(len(s) < 3 for s in strings):
        return None
    least = [s for s in sorted(strings) if not any(t != s and t in s for t in strings)]  # a longer string holds what one inside it does
    return _both("or", [_both("and", [("has", s[i:i + 3]) for i in range(len(s) - 2)]) for s in least])


def _characters(items) -> set[str] | None:
    out: set[str] = set()
    for op, arg in items:
        if op is rc.LITERAL:
            out.add(chr(arg).lower())
        elif op is rc.RANGE and arg[1] - arg[0] < 8:
            out |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return out if len(out) <= 8 else None


def _derive(tree) -> tuple[set[str] | None, object]:
    """(every string the expression matches, if few; else None, query) for a parsed expression, lower-cased."""
    exact: set[str] | None = {""}
    queries = []

    def spend():
        nonlocal exact
        if exact is not None:
            queries.append(_of_strings(exact))
        exact = None

    for op, arg in tree:
        if op is rc.LITERAL:
            got = ({chr(arg).lower()}, None)
        elif op is rc.IN:
            got = (_characters(arg), None)
        elif op is rc.SUBPATTERN:
            got = _derive(arg[3])
        elif op is rc.BRANCH:
            parts = [_derive(x) for x in arg[1]]
            if all(e is not None for e, _ in parts):
                got = (set().union(*(e for e, _ in parts)), None)
            else:
                each = [q if e is None else _of_strings(e) for e, q in parts]
                got = (None, None if any(q is None for q in each) else _both("or", each))
        elif op is rc.MAX_REPEAT and arg[0] == 0 and arg[1] == 1 and (one := _derive(arg[2])[0]) is not None:
            got = (one | {""}, None)
        elif op is rc.MAX_REPEAT and arg[0] >= 1:
            e, q = _derive(arg[2])
            got = (None, q if e is None else _of_strings(e))
        else:
            got = (None, None)
        e, q = got
        if e is None:
            spend()
            queries.append(q)
            exact = {""}
        else:
            if len(exact) * len(e) > EXACT_LIMIT:
                spend()
                exact = {""}
            exact = {a + b for a, b in product(exact, e)}
    if not queries:
        return exact, None
    spend()
    return None, _both("and", queries)


def trigram_query(pattern: str):
    """Boolean query over lower-case trigrams that each text with a match satisfies; None if there is none."""
    exact, query = _derive(rp.parse(pattern))
    return _of_strings(exact) if exact is not None else query


def _trigrams(query) -> set[str]:
    return set() if query is None else {query[1]} if query[0] == "has" else set().union(*map(_trigrams, query[1]))


def _test(query, held: Column) -> Column:
    if query[0] == "has":
        return F.array_contains(held, query[1])
    return reduce((lambda a, b: a & b) if query[0] == "and" else (lambda a, b: a | b), [_test(q, held) for q in query[1]])


def text_key(text: Column) -> Column:
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(7), text).alias("b"))


def build_index(texts: DataFrame, rules=RULES) -> DataFrame:
    """Postings (trigram, key) over ``texts`` (text) for the trigrams in the rules' queries."""
    grams = sorted(set().union(*(_trigrams(trigram_query(r.pattern)) for r in rules)))
    held = F.array_compact(F.array(*[F.when(F.contains(F.col("_low"), F.lit(g)), F.lit(g)) for g in grams]))
    return (texts.where("text IS NOT NULL").select(text_key(F.col("text")).alias("key"), F.lower("text").alias("_low"))
            .select("key", F.explode(held).alias("trigram")))


def candidates(postings: DataFrame, rules=RULES) -> DataFrame:
    """(key, rules): the indexed rules whose query a text's postings satisfy."""
    asked = [(i, q) for i, r in enumerate(rules) if (q := trigram_query(r.pattern)) is not None]
    rare = reduce(lambda a, b: a | b, [_test(q, F.col("held")) for _, q in asked])
    found = postings.groupBy("key").agg(F.collect_set("trigram").alias("held")).where(rare)
    return found.select("key", F.array_compact(F.array(*[F.when(_test(q, F.col("held")), F.lit(i)) for i, q in asked])).alias("rules"))


def _bound(value: Column, use) -> Column:
    """``use(value)``, with the value computed once however often ``use`` reads it inside other lambdas."""
    return F.get(F.transform(F.array(value), use), 0)


def _before(values: Column, join) -> Column:
    """For each of the whole numbers ``values`` the ``join`` (a sum or the greatest) of 0 and all before it.

    Runs over blocks of ``BLOCK`` values and then over the blocks: appending copies an
    array, so one run over all would cost the square of their number.
    """
    def run(items, of_type, at, out):
        start = F.struct(F.lit(0).alias("at"), F.expr(f"CAST(array() AS {of_type})").alias("out"))
        return F.aggregate(items, start, lambda acc, x: F.struct(
            join(acc["at"], at(x)).alias("at"), F.concat(acc["out"], F.array(out(acc["at"], x))).alias("out")))

    def blocks(v):
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")), lambda b: run(
            F.slice(v, b * BLOCK + 1, F.lit(BLOCK)), "ARRAY<INT>", lambda x: x, lambda at, x: at))

    whole = run(_bound(values, blocks), "ARRAY<ARRAY<INT>>", lambda x: x["at"], lambda at, x: F.transform(x["out"], lambda y: join(at, y)))
    return F.when(F.size(values) > 0, F.flatten(whole["out"])).otherwise(F.expr("CAST(array() AS ARRAY<INT>)"))


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, order, end) of a rule's matches: lengths of the gaps and matches, summed along the text."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    tested = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    steps = F.transform(F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), whole.alias("hit"), tested.alias("part")), lambda x: F.struct(
        F.char_length(x["gap"]).alias("gap"), F.coalesce(F.char_length(x["hit"]), F.lit(0)).alias("hit"),
        F.coalesce(F.char_length(x["part"]) >= rule.least, F.lit(False)).alias("good")))

    def place(s):
        placed = F.zip_with(s, _before(F.transform(s, lambda x: x["gap"] + x["hit"]), lambda a, b: a + b), lambda x, at: F.struct(
            x["good"].alias("good"), (at + x["gap"]).alias("start"), (at + x["gap"] + x["hit"]).alias("end")))
        return F.transform(F.filter(placed, lambda x: x["good"]), lambda x: F.struct(
            x["start"].alias("start"), F.lit(order).alias("ord"), x["end"].alias("end")))

    return _bound(steps, place)


def find_secrets(docs: DataFrame, text_col: str = "text", rules=RULES) -> DataFrame:
    """``docs`` plus ``spans``: array of (start, ord, end) in code points, end exclusive; ``ord`` numbers ``rules``."""
    hits = candidates(build_index(docs.select(F.col(text_col).alias("text")), rules), rules).select(
        F.col("key").alias("_key"), F.col("rules").alias("_rules"))
    rows = docs.drop("spans").withColumn("_text", F.coalesce(F.col(text_col), F.lit(""))).withColumn("_key", text_key(F.col(text_col)))
    rows = rows.join(hits, "_key", "left")
    found = []
    for i, r in enumerate(rules):
        wanted = (F.regexp_like("_text", F.lit(r.pattern)) if trigram_query(r.pattern) is None
                  else F.coalesce(F.array_contains("_rules", i), F.lit(False)))
        none = F.expr("CAST(array() AS ARRAY<STRUCT<start: INT, ord: INT, end: INT>>)")
        found.append(F.when(wanted, _spans(F.col("_text"), r, i)).otherwise(none))
    return rows.withColumn("spans", F.array_sort(F.concat(*found))).drop("_text", "_key", "_rules")


def span_text(spans: Column, rules=RULES) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["ord"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with the characters of ``spans`` (sorted by start) replaced by ``mark``, overlapping spans by one."""
    def piece(cut, start, end):
        """Characters from start to end of a text cut into parts of ``CUT``, whose middle parts are taken whole."""
        first, last = F.floor(start / CUT).cast("int"), F.floor(end / CUT).cast("int")
        head, tail = F.coalesce(F.get(cut, first), F.lit("")), F.coalesce(F.get(cut, last), F.lit(""))
        return F.when(first == last, F.substring(head, start % CUT + 1, end - start)).otherwise(F.concat(
            F.substring(head, start % CUT + 1, F.lit(CUT)), F.array_join(F.slice(cut, first + 2, last - first - 1), ""),
            F.substring(tail, F.lit(1), end % CUT)))

    def kept(s):
        """(start, end) of what stays: before each span that begins after the end of all before it, and after the last."""
        ends = F.transform(s, lambda x: x["end"])
        gaps = F.zip_with(s, _before(ends, F.greatest), lambda x, at: F.struct(at.alias("start"), x["start"].alias("end")))
        rest = F.struct(F.array_max(ends).alias("start"), F.char_length(text).alias("end"))
        return F.concat(F.filter(gaps, lambda x: x["end"] >= x["start"]), F.array(rest))

    def replaced(cut):
        return F.array_join(F.transform(_bound(spans, kept), lambda x: piece(cut, x["start"], x["end"])), mark)

    cut = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % CUT), F.lit(0))
    return F.when(F.size(spans) > 0, _bound(cut, replaced)).otherwise(text)
