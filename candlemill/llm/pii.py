"""Personal data: base patterns, and contexts bootstrapped from what they find.

Base matches are seed instances. Tokens of a looser shape (numbers without plus or check digit,
disguised addresses) are open instances. Both stand behind one or two words; these words are the
lexical patterns. Spark scores the graph of patterns and instances in rounds: a pattern is trusted by
the believed instances behind it against the known negatives there (numbers whose check digit fails,
dates, version numbers), an instance as far as a trusted pattern names it. Instances that are neither
don't count against a pattern, but believed ones must be a tenth of all behind it.
A pattern must also be *specific*: what it names must make up a good part of all that stands behind
those words in the corpus. Open instances that come to be believed are added as spans.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.shared import fields, map_rows, staged

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
MIN_SUPPORT = 5
"""Distinct values a pattern must stand before, at least; the same for tables of every size."""
MIN_TRUST = 0.9
"""Believed instances among those that are believed or known negatives."""
MIN_BELIEVED = 0.1
"""Believed instances among all behind a pattern: five phones don't make phones of a word's 100 orders."""
MIN_SPECIFIC = 0.2
MIN_BELIEF = 0.85
MOST_BITS = 27
"""The sieve of patterns that is sent to all executors has at most 2**27 bits (16 MiB)."""
WINDOW = 80
"""Characters before an instance that are looked at first for its context; more where words are longer."""

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
GLUE = re.compile(r"[^\w](?=.)", re.DOTALL)

# Looser shapes for identifiers the base patterns don't know.
OPEN_EMAIL = re.compile(
    r"(?<![\w.%+-])[\w.%+-]++ ?(?:@|\(at\)|\[at\]) ?[\w-]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[\w-]++)*+",
    re.IGNORECASE,
)
OPEN_IP = re.compile(r"(?<![\w:.])[0-9A-Fa-f]{1,4}(?::{1,2}[0-9A-Fa-f]{1,4}){3,7}(?![\w:])")
OPEN_NUMBER = re.compile(r"(?:\+|(?<![\w.,-]))\(?[0-9](?:[ ()./-]{0,2}[0-9]){6,18}(?![\w-]|[.,][0-9])")
# Numbers that are no phones: dates, with a time or not, and dotted versions.
NO_PHONE = re.compile(
    r"(?:(?:19|20)[0-9]{2}([-/.])(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12][0-9]|3[01])"
    r"|(?:0?[1-9]|[12][0-9]|3[01])([-/.])(?:0?[1-9]|[12][0-9]|3[01])\2(?:19|20)[0-9]{2})(?: [0-9 ]+)?"
    r"|[0-9]{1,4}(?:\.[0-9]{1,4}){3}"
)

BASE = fields(
    "doc_id long, row long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
    "spans string, kinds strings, starts ints, ends ints, seeds ints, values strings, ones strings, "
    "twos strings"
)
CONTEXTS = fields("pattern string, times long")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    for d in digits[-2::-2]:
        total += 2 * int(d) if d < "5" else 2 * int(d) - 9
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, kinds in order; places are code points."""
    spans = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if not DIGIT.search(text):
        return spans
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m[0].split("."))):
            spans.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(DIGIT.findall(m[0])) <= 15:
                spans.append(("phone", m.start(), m.end()))
    return spans


def gaps(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    """Stretches (start, end) of the text outside the spans."""
    at = 0
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if start > at:
            yield at, start
        at = max(at, end)
    if at < len(text):
        yield at, len(text)


def open_spans(text: str, spans: list[tuple[str, int, int]] = ()) -> list[tuple[str, int, int]]:
    """Identifier-like stretches of a looser shape, in what the base spans leave."""
    found = []
    mail = "@" in text or "(at)" in text.lower() or "[at]" in text.lower()
    number = DIGIT.search(text)
    for part in gaps(text, spans):
        if mail:
            found += [("email", *m.span()) for m in OPEN_EMAIL.finditer(text, *part)]
        if number and ":" in text:
            found += [("ip", *m.span()) for m in OPEN_IP.finditer(text, *part)]
        for m in OPEN_NUMBER.finditer(text, *part) if number else ():
            digits = len(DIGIT.findall(m[0]))
            if 7 <= digits <= 19:
                most = 15 if m[0][0] == "+" else 12
                found.append(("card" if digits > most else "phone", *m.span()))
    return found


def is_negative(kind: str, value: str) -> bool:
    """Is an open instance known not to be of its kind?"""
    if kind == "card":
        return not luhn("".join(DIGIT.findall(value)))
    return kind == "phone" and NO_PHONE.fullmatch(value) is not None


def apart(spans: list[tuple[str, int, int]], others: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Those of ``others`` that touch none of ``spans``."""
    marks = sorted((a, b) for _, a, b in spans)
    out, i, reach = [], 0, -1
    for span in sorted(others, key=lambda s: s[1]):
        while i < len(marks) and marks[i][0] < span[2]:
            reach = max(reach, marks[i][1])
            i += 1
        if reach <= span[1]:
            out.append(span)
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    ordered = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in ordered)


def contexts(text: str, start: int) -> tuple[str, str]:
    """The word and the two words before a place, lower-cased, whole; empty where there are none."""
    size = WINDOW
    while True:
        before = text[max(0, start - size) : start]
        # Two whole words: what stands before them, too, or white space, or the text's begin.
        if size >= start or len(before.split(None, 2)) > 2 or (before[:1].isspace() and len(before.split()) == 2):
            break
        size *= 4
    words = before.lower().split()[-2:]
    return words[-1] if words else "", " ".join(words) if len(words) == 2 else ""


def value_of(kind: str, text: str) -> str:
    return text.lower() if kind in ("email", "ip") else "".join(DIGIT.findall(text))


def _based(columns: dict) -> Iterator[tuple]:
    for doc_id, row, text in zip(columns["doc_id"], columns["row"], columns["text"], strict=True):
        text = text or ""
        spans = base_spans(text)
        loose = apart(spans, open_spans(text, spans))
        both = [(s, 1) for s in spans] + [(s, -is_negative(s[0], text[s[1] : s[2]])) for s in loose]
        around = [contexts(text, s[1]) for s, _ in both]
        base = joined(spans)
        counts = Counter(kind for kind, _, _ in spans)
        yield (
            doc_id, row, *(counts[k] for k in KINDS), hashlib.sha256(base.encode()).hexdigest(), base,
            [s[0] for s, _ in both], [s[1] for s, _ in both], [s[2] for s, _ in both],
            [seed for _, seed in both], [value_of(s[0], text[s[1] : s[2]]) for s, _ in both],
            [one for one, _ in around], [two for _, two in around],
        )


class _Stands(dict):
    """Contexts a word gives that may be patterns: itself, and what stands before a value glued to it."""

    def __init__(self, bits: int, sieve: bytes):
        self.shift, self.sieve = 32 - bits, sieve

    def passes(self, pattern: str) -> int:
        return self.holds(zlib.crc32(pattern.encode("utf-8", "surrogatepass")))

    def holds(self, crc: int) -> int:
        slot = crc >> self.shift
        return self.sieve[slot >> 3] >> (slot & 7) & 1

    def __missing__(self, word: str) -> list[str]:
        # One pass over a word of any length: each begin's checksum goes on from the last one's.
        found, crc, at = [], 0, 0
        for end in (*(m.end() for m in GLUE.finditer(word)), len(word)):
            crc, at = zlib.crc32(word[at:end].encode("utf-8", "surrogatepass"), crc), end
            if self.holds(crc):
                found.append(word[:end])
        self[word] = found
        return found


def _counted(columns: dict, bits: int, sieve) -> Iterator[tuple]:
    stands, found = _Stands(bits, sieve.value), Counter()
    for text in columns["text"]:
        before = ""
        for word in (text or "").lower().split():
            for context in stands[word]:
                found[context] += 1
                pair = f"{before} {context}"
                if before and stands.passes(pair):
                    found[pair] += 1
            before = word
    yield from found.items()


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``row``, the key of both: rows that repeat share it, null ids have one too."""
    key, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return docs.select(key.alias("doc_id"), F.xxhash64(key, text).alias("row"), text.alias("text"))


class Discovery:
    """Base spans of a collection, and the spans that bootstrapping adds."""

    def __init__(self, docs: DataFrame):
        self.texts = keyed(docs)
        self.rows = staged(map_rows(self.texts, _based, BASE, rows=1024), "personal")
        self.added = self._bootstrap()

    def _mentions(self) -> DataFrame:
        zipped = F.arrays_zip("kinds", "starts", "ends", "seeds", "values", "ones", "twos")
        return self.rows.select("doc_id", "row", F.explode(zipped).alias("m")).select(
            "doc_id", "row", F.col("m.kinds").alias("kind"), F.col("m.starts").alias("start"),
            F.col("m.ends").alias("end"), F.col("m.seeds").alias("seed"),
            F.col("m.values").alias("value"), F.array("m.ones", "m.twos").alias("patterns"),
        )

    def _bootstrap(self) -> DataFrame:
        """(doc_id, row, kind, start, end) of open instances that come to be believed.

        ``seed`` is 1 for a seed, -1 for a known negative, 0 for what is undecided. A number whose check
        digit fails speaks against a pattern of cards, but is one (mistyped) behind a trusted pattern.
        """
        mentions = self._mentions()
        # The graph: one edge per pattern and value, copies combined before the shuffle.
        edges = staged(
            mentions.select("kind", "value", "seed", F.explode("patterns").alias("pattern"))
            .where("pattern <> ''").groupBy("kind", "pattern", "value")
            .agg(F.max("seed").alias("seed"), F.count("*").alias("times")), "edges",
        )
        patterns = staged(
            edges.groupBy("kind", "pattern").agg(
                F.count("*").alias("values"), F.count_if(F.col("seed") == 1).alias("seeds"), F.sum("times").alias("named")
            ).where((F.col("values") >= MIN_SUPPORT) & (F.col("values") > F.col("seeds"))), "patterns",
        )
        nothing = mentions.select("doc_id", "row", "kind", "start", "end").where(F.lit(False))
        if patterns.isEmpty():
            return nothing
        specific = staged(
            patterns.join(self._totals(patterns), "pattern")
            .where(F.col("named") >= MIN_SPECIFIC * F.col("times")).select("kind", "pattern"), "specific",
        )
        if specific.isEmpty():
            return nothing
        graph = staged(edges.drop("times").join(specific, ["kind", "pattern"]), "graph")
        belief = graph.select("kind", "value", F.greatest("seed", F.lit(0)).cast("double").alias("belief"))
        belief = belief.groupBy("kind", "value").agg(F.max("belief").alias("belief"))
        undenied = F.sum(F.when(F.col("seed") >= 0, F.col("belief")))
        denied = F.count_if(F.col("seed") < 0)
        for _ in range(ROUNDS):
            trust = (
                graph.join(belief, ["kind", "value"]).groupBy("kind", "pattern")
                .agg(undenied.alias("believed"), denied.alias("denied"), F.count("*").alias("values"))
                .withColumn("trust", F.try_divide("believed", F.col("believed") + F.col("denied")))
                .where((F.col("trust") >= MIN_TRUST) & (F.col("believed") >= MIN_SUPPORT)
                       & (F.col("believed") >= MIN_BELIEVED * F.col("values")))
            )
            doubt = F.sum(F.log1p(-F.least(F.coalesce("trust", F.lit(0.0)), F.lit(0.999999))))
            belief = staged(
                graph.join(trust, ["kind", "pattern"], "left").groupBy("kind", "value")
                .agg(F.greatest(F.max("seed").cast("double"), 1 - F.exp(doubt)).alias("belief")), "belief",
            )
        sure = belief.where(F.col("belief") >= MIN_BELIEF).select("kind", "value")
        return (
            mentions.where("seed = 0 or seed < 0 and kind = 'card'").join(sure, ["kind", "value"])
            .withColumn("pattern", F.explode("patterns")).join(specific, ["kind", "pattern"], "left_semi")
            .select("doc_id", "row", "kind", "start", "end").distinct()
        )

    def _totals(self, patterns: DataFrame) -> DataFrame:
        """How often the words of each pattern stand anywhere in the corpus.

        The sieve only keeps words that no pattern has out of the shuffle; what it lets pass beyond the
        patterns falls out of the join. Its bits reach the driver in words, at most 2**21.
        """
        bits = min(MOST_BITS, max(16, patterns.count().bit_length() + 4))
        listed = patterns.select(F.explode(F.array("pattern", F.substring_index("pattern", " ", -1))).alias("p"))
        rows = (
            listed.select(F.shiftright(F.crc32(F.encode("p", "UTF-8")), 32 - bits).alias("slot"))
            .groupBy(F.expr("slot div 64").alias("word"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(pmod(slot, 64) AS int)))").alias("bits")).toPandas()
        )
        words = np.zeros(1 << (bits - 6), "<i8")
        words[rows["word"].to_numpy()] = rows["bits"].to_numpy()
        sieve = self.texts.sparkSession.sparkContext.broadcast(words.tobytes())
        counts = map_rows(self.texts.select("text"), _counted, CONTEXTS, bits, sieve)
        return staged(counts.groupBy("pattern").agg(F.sum("times").alias("times")), "totals")

    def spans(self) -> DataFrame:
        """Per input row: doc_id, base counts and digest, all spans."""
        more = self.added.groupBy("doc_id", "row").agg(
            F.collect_list(F.struct("kind", "start", "end")).alias("more")
        ).withColumnsRenamed({"doc_id": "its_doc_id", "row": "its_row"})
        base = F.filter(F.split("spans", ","), lambda s: s != "").alias("base")
        rows = self.rows.select(
            "doc_id", "row", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", base
        )
        rows = rows.join(
            more, (rows["row"] == more["its_row"]) & rows["doc_id"].eqNullSafe(more["its_doc_id"]), "left"
        )
        rank = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
        every = F.transform(
            F.array_sort(F.concat(
                F.transform("base", lambda s: _span(F.split(s, ":"), rank)),
                F.transform("more", lambda s: F.struct(
                    rank[s["kind"]].alias("rank"), s["start"].alias("start"), s["end"].alias("end"),
                    s["kind"].alias("kind"),
                )),
            )),
            lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]),
        )
        return rows.select(
            "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256",
            F.when(F.col("more").isNull(), F.col("spans")).otherwise(F.array_join(every, ",")).alias("spans"),
        )


def _span(parts, rank):
    return F.struct(
        rank[parts[0]].alias("rank"), parts[1].cast("int").alias("start"),
        parts[2].cast("int").alias("end"), parts[0].alias("kind"),
    )


def find_personal(docs: DataFrame) -> DataFrame:
    """Per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Counts and digest are of the base patterns; ``spans`` also has what bootstrapping adds. A null
    text is empty and gets the digest of nothing; rows that repeat or have no id are each answered;
    an empty table gives none; further columns are ignored.
    """
    return Discovery(docs).spans()


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every stretch of spans replaced by the kind that starts first."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], KINDS.index(s[0]))):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    out.append(text[at:])
    return "".join(out)


def _redacted(columns: dict, text_at: int, size_at: int) -> Iterator[tuple]:
    rows = list(zip(*(v for n, v in columns.items() if n != "more personal"), strict=True))
    more = columns.get("more personal", [None] * len(rows))
    for row, added in zip(rows, more, strict=True):
        text = row[text_at]
        if text:
            spans = base_spans(text) + [
                (kind, int(a), int(b)) for kind, a, b in (s.split(":") for s in added or ())
            ]
            if spans:
                cells = list(row)
                cells[text_at] = redacted(text, spans)
                if size_at >= 0 and cells[size_at] is not None:
                    cells[size_at] = len(cells[text_at])
                row = tuple(cells)
        yield row


def redact(docs: DataFrame) -> DataFrame:
    """The documents with personal data replaced by its kind; ``n_chars``, if there, follows.

    Base spans are found again where the text is read; only added ones, if any, are joined. Null and empty
    texts stay as they are; rows that repeat or have no id are each answered; an empty table gives none; all
    other columns, whatever their names, pass through.
    """
    added = staged(Discovery(docs).added, "added")
    names = docs.columns
    places = names.index("text"), names.index("n_chars") if "n_chars" in names else -1
    if added.isEmpty():
        return map_rows(docs, _redacted, docs.schema, *places)
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    more = added.groupBy(F.col("doc_id").alias("its doc_id"), F.col("row").alias("its row")).agg(
        F.collect_list(F.concat_ws(":", "kind", "start", "end")).alias("more personal")
    )
    mine = (key == more["its row"]) & F.col("doc_id").cast("long").eqNullSafe(more["its doc_id"])
    joined_rows = docs.join(more, mine, "left").drop("its doc_id", "its row")
    return map_rows(joined_rows, _redacted, docs.schema, *places)
