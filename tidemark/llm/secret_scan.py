r"""Secret scans: fixed patterns plus sliding-window Shannon entropy over candidate strings.

Base kinds, each leftmost and non-overlapping within its kind, offsets in code points:

* ``assign``  keyword, ``:`` or ``=``, value (the whole match is the span; value of 8+ characters)
* ``access``  ``AKIA`` and capitals or digits, 16+ characters in all
* ``hex``     a run of 32+ lower-case hex digits

The method adds ``entropy`` spans.  Base spans are blanked first, kind by kind
as listed; candidate strings are the maximal runs of 20+ characters of
``[A-Za-z0-9+/_=-]`` that are left, so the key behind a base span is one of its
own.  A window of 20 characters slides over a candidate; the counts of the
entering and the leaving character change the sum of ``c * log2 c`` step by
step, so each step costs two counts and no entropy is recomputed.  A candidate
is reported when its highest window entropy reaches the threshold of its
character class (hex; letters without a digit; mixed) and it matches no
allow-list pattern.  Letters of one case, and letters that read as words in
camel case or joined by marks, are on the allow-list: their entropy is that of
long words.

Offsets are running sums of lengths, taken by doubling steps, so a text with
very many matches costs their number times its logarithm.

Everything is a built-in SQL function (split, regexp_extract_all, transform,
aggregate): no Python runs on the executors, nothing is shuffled.

Defined cases: a null or empty text has no spans (``base_sha256`` is the hash
of the empty string); the rows are judged one by one, so repeated rows, null
doc_ids, empty tables and other columns are no special case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ._stage import free_name

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
MIN_VALUE = 8
# a shorter run holds no longer one, so the bounds can stand in the patterns
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: bits a character of a window, by class of the candidate
HEX_BITS, LETTER_BITS, MIXED_BITS = 3.0, 3.8, 3.7
#: candidates that look random but are no secrets
ALLOW = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # UUID
    r"^[0-9+/_=-]+$",  # numbers, dates, rules
    r"(?i)(example|sample|dummy|placeholder|changeme|your[_-])",
    r"^[a-z]+([/_-][a-z]+)*[/_-]?[0-9]{1,4}$",  # path or slug with a number
    r"^[a-z+/_=-]+$",  # lower-case words
    r"^[A-Z+/_=-]+$",  # upper-case words
    r"^(?:[+/_=-]|[A-Z]++[a-z]{2,}+|[a-z]{2,}+|[A-Z]{2,}+(?![a-z]))*+$",  # words in camel case or joined by marks
)
MARK = "[SECRET]"
BLANK = "\x01"
#: characters of the blocks in which a text is cut for redaction
BLOCK = 1024
_SPAN = "array<struct<start:int,ord:int,end:int,kind:string>>"


def _sql(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\x27") + "'"


def _once(value: str, name: str, body: str) -> str:
    """``body`` with ``value`` bound to ``name``, evaluated once: the variable of a one-element transform."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _running(values: str, op: str = "v + {}") -> str:
    """Running sums (or another ``op``) of an array of longs: after step j each entry covers its last 2^j values."""
    step = f"transform(a, (v, i) -> if(i >= shiftleft(1, j), {op.format('element_at(a, greatest(i - shiftleft(1, j), 0) + 1)')}, v))"
    return _once(values, "n", f"aggregate(sequence(0, 30), n, (a, j) -> if(shiftleft(1, j) < size(a), {step}, a))")


def _pieces(text: str, pattern: str) -> str:
    """(gap, m, v) in text order: the piece before a match, the match and its value (null after the last piece)."""
    p, group = _sql(pattern), "1" if pattern == ASSIGN else "0"
    return (f"zip_with(split({text}, {p}, -1), zip_with(regexp_extract_all({text}, {p}, 0), regexp_extract_all({text}, {p}, {group}), "
            "(m, v) -> named_struct('m', m, 'v', v)), (g, x) -> named_struct('gap', g, 'm', x.m, 'v', x.v))")


def _matches(text: str, pattern: str, kind: str, order: int, guard: str, keep: str = "true") -> str:
    """Spans of ``pattern`` in ``text`` for which ``keep`` (over x.m, x.v) holds; a match ends at the sum of all lengths up to it."""
    ends = _running("transform(f, x -> cast(length(x.gap) + coalesce(length(x.m), 0) as bigint))")
    placed = f"filter(zip_with(f, {ends}, (x, e) -> named_struct('e', cast(e as int), 'm', x.m, 'v', x.v)), x -> x.m is not null and {keep})"
    spans = f"transform({placed}, x -> named_struct('start', x.e - length(x.m), 'ord', {order}, 'end', x.e, 'kind', '{kind}'))"
    return f"if({guard}, {_once(_pieces(text, pattern), 'f', spans)}, cast(array() as {_SPAN}))"


def _blanked(text: str, pattern: str, guard: str, keep: str = "true") -> str:
    """``text`` with each character of the matches that hold replaced by one that no pattern takes; offsets stay."""
    joined = f"transform({_pieces(text, pattern)}, x -> concat(x.gap, if(x.m is null, '', if({keep}, repeat('{BLANK}', length(x.m)), x.m))))"
    return f"if({guard}, array_join({joined}, ''), {text})"


def _digest(spans: str) -> str:
    return f"array_join(transform({spans}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')"


def _entropy(chars: str) -> str:
    """Highest window entropy of an array of characters (at least WINDOW long), by incremental counts."""
    count = lambda x, lo, n: f"size(filter(slice({chars}, {lo}, {n}), y -> y = {x}))"
    term = lambda k: f"if({k} > 1, ({k}) * log2(greatest({k}, 1)), 0D)"
    # in: occurrences of the entering character among those that stay; out: of the leaving one in the old window
    counted = (f"transform({chars}, (c, i) -> named_struct('k', {count('c', f'greatest(i - {WINDOW} + 2, 1)', f'least(i, {WINDOW} - 1)')}, "
               f"'o', if(i >= {WINDOW}, {count(f'element_at({chars}, cast(i - {WINDOW} + 1 as int))', f'i - {WINDOW} + 1', WINDOW)}, 0)))")
    deltas = f"transform({counted}, x -> {term('x.k + 1')} - {term('x.k')} - if(x.o > 0, {term('x.o')} - {term('x.o - 1')}, 0D))"
    return (f"aggregate({deltas}, named_struct('n', 0, 's', 0D, 'best', 0D), (a, d) -> named_struct('n', a.n + 1, 's', a.s + d, "
            f"'best', if(a.n + 1 >= {WINDOW}, greatest(a.best, log2({WINDOW}) - (a.s + d) / {WINDOW}), a.best)), a -> round(a.best, 6))")


def _suspect(x: str) -> str:
    """Whether candidate ``x`` is as disordered as its class demands and not allow-listed."""
    allowed = " or ".join(f"{x} rlike {_sql(p)}" for p in ALLOW)
    bits = f"case when not {x} rlike '[0-9]' then {LETTER_BITS}D when {x} rlike '^[0-9a-fA-F]+$' then {HEX_BITS}D else {MIXED_BITS}D end"
    return f"not ({allowed}) and {_once(f'split({x}, {chr(39)}{chr(39)})', 'chars', _entropy('chars'))} >= {bits}"


def with_spans(docs: DataFrame, text: str, base: str, spans: str) -> DataFrame:
    """``docs`` with array columns of the base spans and of all spans, both by start, then kind."""
    t, raw, left = f"`{text}`", free_name(docs, "llm_text"), free_name(docs, "llm_left")
    df = docs.withColumn(raw, F.expr(f"coalesce({t}, '')")).withColumn(left, F.col(raw))
    kinds = (("assign", ASSIGN, lambda x: f"(contains({x}, '=') or contains({x}, ':')) and {x} rlike {_sql(ASSIGN)}", f"length(x.v) >= {MIN_VALUE}"),
             ("access", ACCESS, lambda x: f"contains({x}, 'AKIA')", "true"),
             ("hex", HEX, lambda x: f"{x} rlike '[0-9a-f]{{32}}'", "true"))
    found = [_matches(raw, pattern, kind, order, guard(raw), keep) for order, (kind, pattern, guard, keep) in enumerate(kinds)]
    df = df.withColumn(base, F.expr(f"array_sort(concat({', '.join(found)}))"))
    for _, pattern, guard, keep in kinds:
        df = df.withColumn(left, F.expr(f"if(size({base}) > 0, {_blanked(left, pattern, guard(left), keep)}, {left})"))
    more = _matches(left, CANDIDATE, "entropy", 3, f"{left} rlike r'{CANDIDATE}'", _suspect("x.m"))
    return df.withColumn(spans, F.expr(f"array_sort(concat({base}, {more}))")).drop(raw, left)


def secrets(docs: DataFrame) -> DataFrame:
    """doc_id, base counts and digests of the spans of every row."""
    df = with_spans(docs.select("doc_id", "text"), "text", "base", "found")
    n = lambda kind: F.expr(f"cast(size(filter(base, x -> x.kind = '{kind}')) as bigint)").alias(f"n_{kind}")
    return df.select("doc_id", n("assign"), n("access"), n("hex"), F.expr(f"sha2({_digest('base')}, 256)").alias("base_sha256"),
                     F.expr(_digest("found")).alias("spans"))


def _cut(a: str, b: str) -> str:
    """Characters a to b (end exclusive) of the text whose blocks are ``k``; no block before a is read."""
    one, other = f"cast({a} div {BLOCK} as int)", f"cast({b} div {BLOCK} as int)"
    return (f"case when {b} <= {a} then '' when {one} = {other} then substring(element_at(k, {one} + 1), cast({a} % {BLOCK} as int) + 1, cast({b} - {a} as int)) "
            f"else concat(substring(element_at(k, {one} + 1), cast({a} % {BLOCK} as int) + 1), array_join(slice(k, {one} + 2, {other} - {one} - 1), ''), "
            f"coalesce(substring(try_element_at(k, {other} + 1), 1, cast({b} % {BLOCK} as int)), '')) end")


def redacted(text: str, spans: str) -> Column:
    """``text`` with every span, overlapping ones joined, replaced by MARK; linear in the text, whatever its number of spans."""
    t = f"`{text}`"
    reach = _running(f"transform({spans}, x -> cast(x.end as bigint))", "greatest(v, {})")
    before = "if(i = 0, 0L, element_at(r, greatest(i, 1)))"
    parts = f"transform({spans}, (x, i) -> if(x.start >= {before}, concat({_cut(before, 'x.start')}, '{MARK}'), ''))"
    whole = f"concat(array_join({parts}, ''), {_cut('element_at(r, -1)', f'length({t})')})"
    blocks = f"regexp_extract_all({t}, r'(?s).{{1,{BLOCK}}}', 0)"
    return F.expr(f"if(size({spans}) > 0, {_once(reach, 'r', _once(blocks, 'k', whole))}, {t})")


def redact(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, same columns, with secrets replaced in ``text`` (and ``n_chars`` counted anew where there is one)."""
    base, spans = free_name(docs, "llm_base"), free_name(docs, "llm_spans")
    df = with_spans(docs, "text", base, spans).withColumn("text", redacted("text", spans))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        df = df.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return df.select(*[F.col(f"`{c}`") for c in docs.columns])
