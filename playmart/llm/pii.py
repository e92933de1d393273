"""Personal data: base patterns, and contextual extraction bootstrapped from what they find.

Base kinds are found by fixed rules. Their occurrences are the seeds: the words around them become
lexical patterns, Spark scores the graph of patterns and the values they surround in a few rounds,
and patterns of high confidence mark further identifiers that no base rule knows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.llm.common import annotate, join_counted, stored

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
# A pattern needs so many different values, and this confidence, before it marks anything.
LEAST_VALUES = 4
CONFIDENT = 0.8
# Patterns below this share pass nothing on to their values.
PASSES_ON = 0.5

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_NOT_DIGIT = re.compile(r"[^0-9]")
_UNIT = re.compile(r"\w+|[^\w\s]")
_INNER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_./+-")
_TRIM = "_./+-"
# Shortest unknown identifier, and how far its context may reach.
LEAST_LENGTH, REACH = 6, 48
# Unknown values of more than one token. Every quantifier over their length is possessive: no run is read twice.
_GROUPED = re.compile(r"(?<![\w.@/-])[+(\[]{0,3}[0-9]++(?:(?:[)\]]?\x20?[-/\u2010-\u2014]?\x20?[(\[]?|\.|[(\[]\.[)\]])[0-9]++)*+")
_COLONS = re.compile(r"(?<![\w:.])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,}+")
_AT = re.compile(r"\x20?@\x20?|\x20?[(\[]at[)\]]\x20?|\x20at\x20", re.IGNORECASE)
_HOST = re.compile(r"[\w-]++(?:(?:\.|\x20dot\x20|\x20?[(\[](?:\.|dot)[)\]]\x20?)[\w-]++)*+", re.IGNORECASE)

FOUND = "array<struct<start:bigint,end:bigint,kind:string,value:bigint,patterns:array<string>>>"
ADDED = "array<struct<start:bigint,end:bigint,kind:string>>"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for chain in _DOTTED.finditer(text):
        parts, at = chain.group().split("."), chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end
            at = end + 1


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            yield m.span()


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, index into KINDS, end) in code points, by start and then kind."""
    if not text:
        return []
    ways = (_emails, _ips, _cards, _phones)
    return sorted((a, k, b) for k, way in enumerate(ways) for a, b in way(text))


def _patterns(text: str, start: int, end: int) -> list[str]:
    left = ["^", "^", *_UNIT.findall(text[max(0, start - REACH) : start].lower())]
    right = _UNIT.search(text[end : end + REACH].lower())
    return [f"{left[-2]} {left[-1]} _", f"{left[-1]} _ {right.group() if right else '$'}"]


def _unknown(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Tokens with a digit, of some length, that touch no base span."""
    done, i = 0, 0
    spans = sorted((a, b) for a, _, b in taken)
    for m in _DIGITS.finditer(text):
        if m.start() < done:
            continue
        a, b = m.span()
        while a > done and text[a - 1] in _INNER:
            a -= 1
        while b < len(text) and text[b] in _INNER:
            b += 1
        done = b
        while text[a] in _TRIM:
            a += 1
        while text[b - 1] in _TRIM:
            b -= 1
        while i < len(spans) and spans[i][1] <= a:
            i += 1
        if b - a >= LEAST_LENGTH and not any(x < b and y > a for x, y in spans[i : i + 8]):
            yield a, b


def _grouped(text: str) -> Iterator[tuple[int, int]]:
    """Digits in groups: joined by a blank, dash, slash, dot or bracket."""
    for m in _GROUPED.finditer(text):
        a, b = m.span()
        if b < len(text) and (text[b].isalnum() or text[b] in "_@"):  # the last group belongs to a word
            while b > a and text[b - 1].isdigit():
                b -= 1
            while b > a and not text[b - 1].isdigit():
                b -= 1
        if b - a >= LEAST_LENGTH:
            yield a, b


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Numbers with colons, and names at a host without a dot or with its signs spelled out."""
    for m in _COLONS.finditer(text):
        a, b = m.span()
        if b - a >= LEAST_LENGTH and (b == len(text) or not (text[b].isalnum() or text[b] == "_")):
            yield a, b
    done = 0
    for at in _AT.finditer(text):
        start = at.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at.end()) if start < at.start() else None
        # a bare word "at" is an address only before a host of several parts
        if host and ("at" not in at.group().lower().split() or re.search(r"\W", host.group())):
            done = host.end()
            yield start, done


def _wider(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Values of several tokens, whole stretches between base spans."""
    done = 0
    for a, _, b in [*sorted(taken), (len(text), 0, len(text))]:
        if a > done:
            for way in (_grouped, _addresses):
                for x, y in way(text[done:a]):
                    yield done + x, done + y
        done = max(done, b)


def _outermost(spans: list[dict]) -> list[dict]:
    """Sorted spans without those inside another one."""
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"], s["kind"])):
        if not out or s["end"] > out[-1]["end"]:
            out.append(s)
    return out


def occurrences(text: str | None) -> list[dict]:
    """Base spans (with kind) and unknown identifiers (kind None), each with value and patterns."""
    if not text:
        return []
    base = base_spans(text)
    spans = [(a, b, KINDS[k]) for a, k, b in base] + [(a, b, None) for a, b in sorted({*_unknown(text, base), *_wider(text, base)})]
    return [
        {"start": a, "end": b, "kind": kind, "patterns": _patterns(text, a, b),
         "value": xxhash.xxh64_intdigest(text[a:b].lower().encode()) - (1 << 63)}
        for a, b, kind in spans
    ]


def score_patterns(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Patterns worth trusting: pattern, kind, confidence.

    `found`: pattern, value, kind (null for values no base rule knows). In every round a pattern's
    confidence for a kind is the sum of its values' confidences over one more than the number of its
    values; a value's is the noisy-or of its patterns', seeds keep one. The graph and each round's
    state are stored, so a lost executor repeats one round at most.
    """
    graph = stored(found.groupBy("pattern", "value").agg(F.max("kind").alias("kind")), "pii-graph").rows
    sizes = graph.groupBy("pattern").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_VALUES)
    seeds = graph.filter("kind is not null").groupBy("value", "kind").agg(F.lit(1.0).alias("c"))
    links = stored(graph.join(sizes, "pattern").select("pattern", "value", "n"), "pii-links").rows
    state = seeds
    for step in range(rounds):
        scored = stored(
            links.join(state, "value").groupBy("pattern", "kind")
            .agg((F.sum("c") / (F.first("n") + 1)).alias("confidence")), "pii-patterns",
        ).rows
        if step + 1 < rounds:
            passed = (
                links.join(scored.filter(F.col("confidence") >= PASSES_ON), "pattern").groupBy("value", "kind")
                .agg((1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("c"))
            )
            state = stored(
                passed.join(seeds.select("value"), "value", "left_anti").select("value", "kind", "c").union(
                    seeds.select("value", "kind", "c")), "pii-values").rows
    return (
        scored.filter(F.col("confidence") >= CONFIDENT).groupBy("pattern")
        .agg(F.max_by("kind", F.struct("confidence", "kind")).alias("kind"), F.max("confidence").alias("confidence"))
    )


def _same(doc_id: str, text: str) -> list[Column]:
    """Two hashes that name a document's content and id; repeated rows share them."""
    both = (F.col(doc_id), F.col(text))
    return [F.xxhash64(*both).alias("h1"), F.hash(*both).alias("h2")]


def discover(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame, int]:
    """All documents' base occurrences, and what the method adds.

    First frame: doc_id, h1, h2, found (array of occurrences). Second: h1, h2, added (array of
    (start, end, kind)), only for documents with additions; the third value is its number of rows.
    """
    keyed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *_same(doc_id, text))

    def make():
        def work(texts):
            return [[occurrences(t) for t in texts.to_pylist()]]

        return work

    base = stored(
        annotate(keyed, [F.col("text")], make, f"found {FOUND}", carry=["doc_id", "h1", "h2"]).select("row.*", "found"),
        "pii-found",
    ).rows
    each = base.select("h1", "h2", F.explode("found").alias("x")).select("h1", "h2", "x.*")
    trusted = stored(score_patterns(each.select(F.explode("patterns").alias("pattern"), "value", "kind"), rounds), "pii-trusted").rows

    def outer():
        return lambda spans: [[_outermost(s) for s in spans.to_pylist()]]

    unknown = each.filter("kind is null").drop("kind").distinct().withColumn("pattern", F.explode("patterns"))
    added = stored(
        join_counted(unknown, trusted, "pattern", "inner", trusted.count())
        .groupBy("h1", "h2", "start", "end").agg(F.max_by("kind", F.struct("confidence", "kind")).alias("kind"))
        .groupBy("h1", "h2").agg(F.collect_list(F.struct("start", "end", "kind")).alias("all"))
        .transform(lambda d: annotate(d, [F.col("all")], outer, f"added {ADDED}", carry=["h1", "h2"]).select("row.*", "added")), "pii-added",
    ).rows
    return base, added, added.count()


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, base and spans, arrays of (start, kind's index, end, kind) sorted.

    Offsets are code points, ends exclusive. `spans` holds all of `base` and what the method adds;
    an addition never overlaps a base span. Null and empty texts have empty arrays; repeated rows and
    rows without an id give a row each.
    """
    found, added, n = discover(docs, doc_id, text, rounds)
    place = F.array(*[F.lit(k) for k in KINDS])

    def listed(spans: Column) -> Column:
        return F.array_sort(F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.array_position(place, s["kind"]).cast("int").alias("place"),
            s["end"].alias("end"), s["kind"].alias("kind"))))

    base = listed(F.filter("found", lambda s: s["kind"].isNotNull()))
    more = listed(F.coalesce("added", F.array().cast(ADDED)))
    joined = join_counted(found, added, ["h1", "h2"], "left", n)
    return joined.select("doc_id", base.alias("base"), F.array_sort(F.concat(base, more)).alias("spans"))


def masked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars", rounds: int = ROUNDS) -> DataFrame:
    """docs with every span replaced by its kind in angle brackets, and `n_chars` (if there) recounted.

    Overlapping spans are replaced as one, by the kind of the first. A null text stays null.
    """
    _, added, n = discover(docs, doc_id, text, rounds)
    named = docs.select(F.struct("*").alias("doc"), *_same(doc_id, text))
    joined = join_counted(named, added, ["h1", "h2"], "left", n)

    def make():
        def work(texts, extra):
            return [[mask(t, [(x["start"], KINDS.index(x["kind"]), x["end"]) for x in e or ()])
                     for t, e in zip(texts.to_pylist(), extra.to_pylist(), strict=True)]]

        return work

    done = annotate(joined, [F.col(f"doc.{text}"), F.col("added")], make, "clean string", carry=["doc"])
    clean = {text: F.col("clean"), n_chars: F.char_length("clean").cast("long")}
    return done.select(*[clean.get(c, F.col("row.doc")[c]).alias(c) for c in docs.columns])


def mask(text: str | None, added: list[tuple[int, int, int]]) -> str | None:
    if not text:
        return text
    out, done = [], 0
    for a, k, b in sorted(base_spans(text) + added):
        if a >= done:
            out += [text[done:a], f"<{KINDS[k].upper()}>"]
        done = max(done, b)
    return "".join([*out, text[done:]])
