"""Personal data: regular expressions propose spans, checksums confirm them, nearby context words adjust the score.

DataFrame functions only. Base kinds are email, ip, card (Luhn) and phone; further kinds are iban (mod-97) and id (national
number forms such as 000-00-0000, kept only where a context word stands near). A null text is empty and has no spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satellion.llm.common import set_aside
from satellion.llm.spans import SPAN, around, blocks_of, by_kind, digits, let, luhn, matches, mod97, part_of, placed, running_max, spans_of

_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: kind -> (pattern, gate, filter, score). Order is the order of kinds.
KINDS = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda t: t.contains("@"), None, 0.9),
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", lambda t: t.rlike(r"[0-9]\.[0-9]"), lambda v: v.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"), 0.6),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", lambda t: t.rlike("[0-9](?:[\\x20-]?[0-9]){15}"), lambda v: F.length(digits(v)).between(16, 19) & luhn(v), 0.8),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: t.contains("+"), lambda v: F.length(digits(v)).between(8, 15), 0.6),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])", lambda t: t.rlike("(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}\\x20?[A-Z0-9]"), mod97, 0.9),
    "id": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", lambda t: t.rlike("[0-9]{3}-[0-9]{2}-[0-9]{4}"), None, 0.3),
}
BASE = ("email", "ip", "card", "phone")
CONTEXT = {
    "email": "mail|contact|write|reply",
    "ip": r"\bip\b|address|host|server",
    "card": "card|visa|credit|payment|cvv",
    "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|account|bank",
    "id": "ssn|social|security|national|passport|identity",
}


def find_pii(documents: DataFrame, window: int = 40, least: float = 0.5) -> DataFrame:
    """documents with pii added: spans (kind, ord, start, end, value, score), by kind and start; positions count code points.

    Extra columns stay; one named pii is replaced. Rows are taken one by one, so repeated rows and null ids have their own spans;
    an empty table stays empty. Long texts, and many spans in one, cost time nearly in proportion.

    A context word (of the kind's words, in either case, as they follow each other in the text without overlapping) that stands
    within the span widened by window code points on both sides adds 0.3 to the score, 1 at most. Spans that no base rule
    demands stay only with a score of least.
    """
    plain, back = set_aside(documents, ("doc_id", "text"), ("pii",))
    df = plain.withColumn("_text", F.coalesce("text", F.lit("")))
    df = df.withColumns({f"_{k}": matches("_text", p, gate(F.col("_text"))) for k, (p, gate, _, _) in KINDS.items()})
    df = df.withColumns({f"_{k}": spans_of("_text", f"_{k}", p, k, i, keep, score) for i, (k, (p, _, keep, score)) in enumerate(KINDS.items())})

    def judged(kind: str) -> Column:
        own, pattern = F.col(f"_{kind}"), f"(?i){CONTEXT[kind]}"
        words = placed(F.split("_text", pattern, -1), F.regexp_extract_all("_text", F.lit(pattern), F.lit(0)))
        more = lambda s, hit: F.struct(*[s[c].alias(c) for c in ("kind", "ord", "start", "end", "value")], F.when(hit, F.least(F.lit(1.0), s["score"] + 0.3)).otherwise(s["score"]).alias("score"))
        scored = F.zip_with(own, around(own, words, window), more)
        return F.when(F.size(own) > 0, scored if kind in BASE else F.filter(scored, lambda s: s["score"] >= least)).otherwise(F.array().cast(SPAN))

    return back(df.withColumn("pii", by_kind(F.concat(*[judged(k) for k in KINDS]))))


def redact(documents: DataFrame) -> DataFrame:
    """documents with each span of personal data replaced by its kind in angle brackets, longest first where spans overlap; n_chars follows. Null texts stay null. All columns and rows stay."""
    plain, back = set_aside(documents, ("doc_id", "text", "n_chars"))
    df = find_pii(plain)
    ordered = F.sort_array(F.transform("pii", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"))))

    def cut(spans: Column, blocks: Column) -> Column:
        # spans that begin before the last one's end join it
        def join(reach: Column) -> Column:
            at = lambda i: F.coalesce(F.get(reach, i - 1), F.lit(0))
            pieces = F.transform(spans, lambda s, i: F.when(s["start"] >= at(i), F.concat(part_of(blocks, at(i), s["start"]), F.lit("<"), s["kind"], F.lit(">"))).otherwise(""))
            return F.concat(F.array_join(pieces, ""), part_of(blocks, F.element_at(reach, -1), F.length("text")))

        return let(running_max(F.transform(spans, lambda s: -s["back"])), join)

    done = let(ordered, lambda spans: let(blocks_of(F.col("text")), lambda blocks: cut(spans, blocks)))
    df = df.withColumn("text", F.when(F.size("pii") > 0, done).otherwise(F.col("text")))
    return back(df.withColumn("n_chars", F.length("text").cast("long")))
