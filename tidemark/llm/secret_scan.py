"""Secret scan with SQL functions only: fixed patterns, and a test battery for random-looking tokens.

Base patterns give spans of kinds ``assign``, ``access`` and ``hex``. Long tokens outside them are put to a battery:

- The encoding (hex, base 32, base 36, base 62, base 64) is inferred from the characters.
- Chi-squared for a uniform alphabet, a runs test around its middle, and lag-one serial correlation must all be in
  keeping with random symbols.
- Two figures say how unlikely an ordinary word or name of that length is to look so: too few equal pairs of
  characters, and too many changes of character class.
- False discoveries (text taken for random) are controlled over all tokens of the table by the step-up rule, with
  p-values weighted by length, as short tokens carry less evidence.

Only one row of totals and a histogram of at most ``BINS`` rows reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import once
from tidemark.llm.common import kept

# The base patterns and their least lengths.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
ASSIGN_LENGTH = 8
KINDS = ("assign", "access", "hex", "random")

TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
RATE = 0.01  # share of false discoveries
BATTERY_Z = 3.3  # a test of the battery rejects beyond it
PAIR_SHARE, TRIPLE_SHARE = 0.068, 0.0057  # equal pairs and triples of letters in text
CHANGE_SHARE = 0.10  # changes of character class from one character to the next in names and words
BINS, BINS_PER_DECADE = 400, 10

# Alphabets.
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
ALPHABETS = (
    ("[0-9a-f]", DIGITS + "abcdef"), ("[0-9A-F]", DIGITS + "ABCDEF"), ("[A-Z2-7]", UPPER + "234567"),
    ("[0-9a-z]", DIGITS + LOWER), ("[A-Za-z0-9]", UPPER + LOWER + DIGITS), ("[A-Za-z0-9+/]", UPPER + LOWER + DIGITS + "+/"),
)

_SPAN = "array<struct<s:int,e:int,t:string>>"


def _quoted(text: str) -> str:
    return "r'" + text.replace("'", "\\x27") + "'"


def _matches(pattern: str, needs: str | None = None) -> str:
    found = f"regexp_extract_all(text, {_quoted(pattern)}, 0)"
    return f"CASE WHEN {needs} THEN {found} ELSE cast(array() AS array<string>) END" if needs else found


def _places(name: str, pattern: str) -> str:
    """Matches with their code point places; what lies between matches is the text split by the same pattern."""
    walk = f"""aggregate(sequence(0, size(m.{name}) - 1),
        named_struct('p', split(text, {_quoted(pattern)}, -1), 'at', 0, 'out', cast(array() AS {_SPAN})),
        (a, i) -> named_struct('p', a.p, 'at', a.at + length(a.p[i]) + length(m.{name}[i]),
            'out', concat(a.out, array(named_struct('s', a.at + length(a.p[i]),
                'e', a.at + length(a.p[i]) + length(m.{name}[i]), 't', m.{name}[i])))),
        a -> a.out)"""
    return f"CASE WHEN size(m.{name}) = 0 THEN cast(array() AS {_SPAN}) ELSE {walk} END"


def _phi(z: str) -> str:
    """Normal distribution function, by its logistic approximation."""
    return f"1D / (1D + exp(least(700D, -1.5976D * ({z}) - 0.07056D * pow(greatest(-30D, least(30D, ({z}))), 3))))"


def _struct(row: str, keep: tuple[str, ...], **new: str) -> str:
    """A ``named_struct`` of fields kept from ``row`` and new ones."""
    return "named_struct(" + ", ".join([f"'{k}', {row}.{k}" for k in keep] + [f"'{k}', {v}" for k, v in new.items()]) + ")"


def _battery(tokens: str) -> str:
    """Each token with ``n``, whether the battery is content, and the p-value under text."""
    kinds = " ".join(f"WHEN c.t rlike '^{p}+$' THEN '{a}'" for p, a in ALPHABETS)
    steps = [
        _struct("c", ("s", "e"), t="translate(regexp_replace(c.t, '=+$', ''), '-_', '+/')"),
        _struct("c", ("s", "e", "t"), abc=f"CASE WHEN c.t rlike '^[0-9]*$' THEN '' {kinds} ELSE '' END"),
        _struct("c", ("s", "e", "t", "abc"), n="cast(length(c.t) AS double)", k="cast(greatest(length(c.abc), 2) AS double)",
                x="transform(split(c.t, ''), y -> cast(instr(c.abc, y) - 1 AS double))"),
        _struct("c", ("s", "e", "n", "k", "abc"),
                sq="aggregate(split(c.abc, ''), 0D, (a, y) -> a + pow(c.n - length(replace(c.t, y, '')), 2))",
                high="aggregate(c.x, 0D, (a, y) -> a + if(y >= c.k / 2, 1D, 0D))",
                runs="aggregate(zip_with(slice(c.x, 1, cast(c.n AS int) - 1), slice(c.x, 2, cast(c.n AS int) - 1), "
                     "(y, z) -> if((y >= c.k / 2) = (z >= c.k / 2), 0D, 1D)), 1D, (a, y) -> a + y)",
                lag="aggregate(zip_with(slice(c.x, 1, cast(c.n AS int) - 1), slice(c.x, 2, cast(c.n AS int) - 1), "
                    "(y, z) -> (y - (c.k - 1) / 2) * (z - (c.k - 1) / 2)), 0D, (a, y) -> a + y)",
                changes="size(regexp_extract_all(c.t, '[a-z]+|[A-Z]+|[0-9]+|[+/]+', 0)) - 1D"),
        _struct("c", ("s", "e", "n", "k", "abc"),
                chi="(pow((c.k / c.n * c.sq - c.n) / (c.k - 1), 1D / 3) - (1 - 2 / (9 * (c.k - 1)))) "
                    "/ sqrt(2 / (9 * (c.k - 1)))",
                runs="(c.runs - 1 - 2 * c.high * (c.n - c.high) / c.n) / sqrt(greatest(1D, 2 * c.high * (c.n - c.high) "
                     "* (2 * c.high * (c.n - c.high) - c.n) / (c.n * c.n * (c.n - 1))))",
                lag="c.lag / sqrt(c.n - 1) / ((c.k * c.k - 1) / 12)",
                pairs=f"((c.sq - c.n) / 2 - c.n * (c.n - 1) / 2 * {PAIR_SHARE}D) / sqrt(c.n * (c.n - 1) / 2 * "
                      f"{PAIR_SHARE * (1 - PAIR_SHARE)}D + c.n * (c.n - 1) * (c.n - 2) * {TRIPLE_SHARE - PAIR_SHARE ** 2}D)",
                changes=f"((c.n - 1) * {CHANGE_SHARE}D - c.changes) / sqrt((c.n - 1) * {CHANGE_SHARE * (1 - CHANGE_SHARE)}D)"),
        _struct("c", ("s", "e", "n"),
                fits=f"c.abc <> '' AND c.chi < {BATTERY_Z} AND abs(c.runs) < {BATTERY_Z} AND abs(c.lag) < {BATTERY_Z}",
                p=f"least(1D, 2 * least(if(c.k = 16, 1D, {_phi('c.pairs')}), {_phi('c.changes')}))"),
    ]
    out = f"filter({tokens}, c -> length(regexp_replace(c.t, '=+$', '')) >= 20)"
    for step in steps:
        out = f"transform({out}, c -> {step})"
    return out


def _bin(token: str, mean: float) -> str:
    """Bin of the weighted p-value of a token; higher is stronger."""
    return (f"cast(least({BINS - 1}D, greatest(0D, -log10({token}.p * {mean}D / {token}.n + 1e-300D) "
            f"* {BINS_PER_DECADE})) AS int)")


def found_spans(docs: DataFrame, text_column: str = "text", rate: float = RATE,
                keep: list[str] | None = None, into: str = "spans") -> DataFrame:
    """Columns of ``docs`` (``keep``: only these) and ``into``, an array of (s, k, e, kind) by start, then kind; ends are exclusive.

    Null text is empty. Works per row, so repeated rows and ids do not matter. An empty table stays empty. Clashes
    with existing columns are avoided by keeping the row in one struct meanwhile; a column named ``into`` is replaced.
    """
    source = docs.select(F.struct(*(keep or ["*"])).alias("row"),
                         F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    found = once(source, ["row", "text"], F.expr(f"""named_struct(
        'assign', {_matches(ASSIGN, "instr(text, ':') > 0 OR instr(text, '=') > 0")},
        'access', {_matches(ACCESS, "instr(text, 'AKIA') > 0")},
        'hex', {_matches(HEX)}, 'token', {_matches(TOKEN)})"""), "m")
    placed = once(found, ["row"], F.expr(f"""named_struct(
        'assign', filter({_places('assign', ASSIGN)},
                         x -> length(regexp_extract(x.t, {_quoted(ASSIGN)}, 2)) >= {ASSIGN_LENGTH}),
        'access', {_places('access', ACCESS)}, 'hex', {_places('hex', HEX)}, 'token', {_places('token', TOKEN)})"""), "f")
    outside = ("filter(f.token, c -> NOT exists(concat(f.assign, f.access, f.hex), b -> b.s < c.e AND c.s < b.e))")
    tested = once(placed, ["row", "f.assign", "f.access", "f.hex"], F.expr(_battery(outside)), "tested")
    rows = kept(tested.selectExpr(
        "row", *[f"transform({k}, x -> named_struct('s', x.s, 'k', {i}, 'e', x.e, 'kind', '{k}')) AS {k}"
                 for i, k in enumerate(KINDS[:3])], "tested"), "secret-spans")
    tokens = rows.select(F.explode("tested").alias("c"))
    totals = tokens.agg(F.count(F.lit(1)).alias("m"), F.avg("c.n").alias("mean")).first()
    least, mean = BINS, totals.mean or 1.0
    if totals.m:
        counts = dict(tokens.groupBy(F.expr(_bin("c", mean)).alias("b")).count().collect())  # at most BINS rows
        rank = 0
        for b in sorted(counts, reverse=True):
            rank += counts[b]
            if 10 ** (-b / BINS_PER_DECADE) <= rate * rank / totals.m:
                least = b
    added = F.expr(f"""transform(filter(tested, c -> c.fits AND {_bin('c', mean)} >= {least}),
        c -> named_struct('s', c.s, 'k', 3, 'e', c.e, 'kind', '{KINDS[3]}'))""")
    others = [F.col("row")[c].alias(c) for c in keep or docs.columns if c.lower() != into.lower()]
    return rows.select(*others, F.array_sort(F.concat("assign", "access", "hex", added)).alias(into))


def span_text(spans: Column | str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    spans = F.col(spans) if isinstance(spans, str) else spans
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.s, x.e)), ",")


def redacted(text: str = "text", spans: str = "spans", mark: str = "[secret]") -> Column:
    """The text with every span, or union of overlapping ones, replaced by ``mark``."""
    return F.expr(f"""aggregate({spans}, named_struct('out', '', 'at', 0),
        (a, x) -> CASE WHEN x.s >= a.at THEN named_struct('out', concat(a.out, substring({text}, a.at + 1, x.s - a.at), '{mark}'),
                                                         'at', x.e)
                       ELSE named_struct('out', a.out, 'at', greatest(a.at, x.e)) END,
        a -> concat(a.out, substring({text}, a.at + 1)))""")
