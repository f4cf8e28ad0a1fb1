"""Secret scan with native expressions: three patterns and a sliding-window entropy test with an allow list.

Spans are code points, end exclusive. The text between two matches of a pattern and the matches themselves, end to
end, give the text back, so the lengths of both give the place of each match without leaving SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the three base kinds and the least length of what they catch.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 8, 16, 32
KINDS = ("assign", "access", "hex", "entropy")

#: Candidate strings for the entropy test, and what is let pass although it looks random.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALLOWED = (
    r"^[0-9-]+$",
    r"^[A-Za-z]+$",
    r"^[A-Za-z]+([-_/][A-Za-z]+)*$",
    r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"^[-=_+/]+$",
    r"(?i)(example|sample|placeholder|dummy)",
)
WINDOW = 20
#: Least entropy in bits of a window of characters of a class; a window of 20 has at most log2(20) = 4.32.
CLASS_BITS = {"hex": 2.9, "alnum": 3.6, "base64": 3.6}


def _pieces(text: Column, pattern: str, group: int) -> tuple[Column, Column, Column]:
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    return matches, judged, F.split(text, pattern, -1)


def _spans(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Array of (start, kind, end) of the matches whose group has ``least`` characters."""
    matches, judged, between = _pieces(text, pattern, group)
    rows = F.zip_with(
        F.arrays_zip(matches.alias("m"), judged.alias("j")),
        F.slice(between, 1, F.size(between) - 1),
        lambda x, b: F.struct(F.length(b).alias("gap"), F.length(x["m"]).alias("n"), F.length(x["j"]).alias("judged")),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int>>").alias("found"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + x["gap"]
        span = F.struct(begin.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (begin + x["n"]).alias("end"))
        return F.struct(
            (begin + x["n"]).alias("at"),
            F.when(x["judged"] >= least, F.concat(state["found"], F.array(span))).otherwise(state["found"]).alias("found"),
        )

    return F.aggregate(rows, start, step, lambda s: s["found"])


def window_entropy(word: Column, window: int = WINDOW) -> Column:
    """Largest Shannon entropy in bits of any ``window`` characters of ``word``, by counts kept up to date.

    Moving on by one character changes two counts, and the sum of count * log2(count) by their terms. A word shorter
    than the window is taken whole.
    """
    codes = F.transform(F.split(word, ""), F.ascii)
    size = F.least(F.length(word), F.lit(window))
    term = lambda c: F.when(c > 0, c * F.log2(c)).otherwise(F.lit(0.0))
    zero = F.struct(
        F.array().cast("array<int>").alias("inside"),
        F.array_repeat(F.lit(0.0), 128).alias("counts"),
        F.lit(0.0).alias("sum"),
        F.lit(-1.0).alias("best"),
    )

    def moved(counts: Column, at: Column, by: float) -> Column:
        return F.transform(counts, lambda c, k: F.when(k == at, c + F.lit(by)).otherwise(c))

    def step(state: Column, new: Column) -> Column:
        full = F.size(state["inside"]) >= size
        old = F.when(full, F.get(state["inside"], F.lit(0))).otherwise(F.lit(-1))
        out = F.coalesce(F.get(state["counts"], old), F.lit(0.0))
        fewer = moved(state["counts"], old, -1.0)
        before = F.get(fewer, new)
        total = state["sum"] - term(out) + F.when(full, term(out - 1)).otherwise(F.lit(0.0)) - term(before) + term(before + 1)
        inside = F.concat(F.when(full, F.slice(state["inside"], 2, window)).otherwise(state["inside"]), F.array(new))
        bits = F.log2(size.cast("double")) - total / size
        return F.struct(
            inside.alias("inside"),
            moved(fewer, new, 1.0).alias("counts"),
            total.alias("sum"),
            F.when(F.size(inside) >= size, F.greatest(state["best"], bits)).otherwise(state["best"]).alias("best"),
        )

    return F.aggregate(codes, zero, step, lambda s: s["best"])


def _suspicious(word: Column) -> Column:
    """A candidate whose most random window reaches the bits of its character class and which no allow rule covers."""
    allowed = F.lit(False)
    for rule in ALLOWED:
        allowed = allowed | word.rlike(rule)
    bits = (
        F.when(word.rlike("^[0-9a-fA-F]+$"), F.lit(CLASS_BITS["hex"]))
        .when(word.rlike("^[0-9A-Za-z]+$"), F.lit(CLASS_BITS["alnum"]))
        .otherwise(F.lit(CLASS_BITS["base64"]))
    )
    mixed = word.rlike("[0-9]") & word.rlike("[A-Za-z]")
    return mixed & ~allowed & (window_entropy(word) >= bits)


def _entropy_spans(text: Column) -> Column:
    matches, _, between = _pieces(text, CANDIDATE, 0)
    marked = F.transform(matches, lambda m: F.struct(m.alias("m"), F.when(_suspicious(m), 1).otherwise(0).alias("hit")))
    rows = F.zip_with(
        marked,
        F.slice(between, 1, F.size(between) - 1),
        lambda x, b: F.struct(F.length(b).alias("gap"), F.length(x["m"]).alias("n"), x["hit"].alias("hit")),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,kind:int,end:int>>").alias("found"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + x["gap"]
        span = F.struct(begin.alias("start"), F.lit(KINDS.index("entropy")).alias("kind"), (begin + x["n"]).alias("end"))
        return F.struct(
            (begin + x["n"]).alias("at"),
            F.when(x["hit"] == 1, F.concat(state["found"], F.array(span))).otherwise(state["found"]).alias("found"),
        )

    return F.aggregate(rows, start, step, lambda s: s["found"])


def secret_spans(text: Column) -> Column:
    """Array of (start, kind number, end) sorted by start, then kind; kinds are numbered as in ``KINDS``.

    A null text counts as empty. A cheap test with each pattern's rarest part comes first, so most texts cost one look.
    """
    whole = F.coalesce(text, F.lit(""))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    found = [
        F.when(whole.rlike(r"(?i)(?:passw|secret|token|api_?key)"), _spans(whole, "assign", ASSIGN, 2, ASSIGN_LENGTH)),
        # A run that is too short consumes nothing that a longer one could start in, so the length goes into the pattern.
        F.when(whole.contains("AKIA"), _spans(whole, "access", ACCESS, 0, ACCESS_LENGTH)),
        F.when(whole.rlike(f"[0-9a-f]{{{HEX_LENGTH}}}"), _spans(whole, "hex", f"[0-9a-f]{{{HEX_LENGTH},}}", 0, HEX_LENGTH)),
        F.when(whole.rlike(r"[0-9]") & whole.rlike(CANDIDATE), _entropy_spans(whole)),
    ]
    return F.array_sort(F.concat(*[F.coalesce(f, none) for f in found]))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined in order."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.concat_ws(",", F.transform(spans, one))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, spans) for every row of ``docs``; see ``secret_spans``. Repeated rows give repeated results."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), secret_spans(F.col("text")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by ``mark``; overlapping spans become one mark.

    Rows without findings, null texts and all other columns are unchanged, but for ``n_chars``, which follows the text.
    """
    text = F.col("text")
    spans = F.transform(secret_spans(text), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        kept = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(state["out"], kept, F.lit(mark))).otherwise(state["out"]).alias("out"),
        )

    cleaned = F.aggregate(
        spans, zero, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text)))
    )
    out = docs.withColumn("text", F.when(F.size(spans) > 0, cleaned).otherwise(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(text.isNull(), F.col("n_chars")).otherwise(F.length(F.col("text")).cast(dict(docs.dtypes)["n_chars"])))
    return out
