"""Secret scans: base rules, and weak parts of multipart credentials linked within scopes.

DataFrame functions only. Base kinds (assignments, access identifiers, long hex runs) always stand. Weak parts are
identifiers (such as key ids of other makers), bare 40-character secrets and endpoints. Alone each is common; they are reported
only when complementary parts stand within one scope: the interval of `scope` code points on either side of the part is joined
with the intervals of parts of another role (an identifier and a secret, or a secret and an endpoint), by sorted sweeps over both
sides. Weak parts inside a base span are not reported again. A null text is empty and has no spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satellion.llm.common import set_aside
from satellion.llm.spans import SPAN, by_start, chosen, covered, let, matches, near, spans_of

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
#: kind -> (pattern, gate, filter). Order is the order of kinds.
BASE = {
    "assign": (ASSIGN, r"(?i)(?:passw(?:or)?d|secret|token|api_?key)[\"'\x20]*[:=]", lambda v: F.length(F.regexp_extract(v, r"(?s)^[A-Za-z_]+[\"']?\x20*[:=]\x20*[\"']?(.*)$", 1)) >= 8),
    "access": (r"AKIA[A-Z0-9]+", "AKIA[A-Z0-9]{12}", lambda v: F.length(v) >= 16),
    "hex": (r"[0-9a-f]{32,}", "[0-9a-f]{32}", None),
}
WEAK = {
    "weak_id": (r"(?<![A-Za-z0-9_])(?:ASIA|AROA|AIza|ghp_|xox[bap]-|sk_live_|SK)[A-Za-z0-9_-]{12,}", r"(?:ASIA|AROA|AIza|ghp_|xox[bap]-|sk_live_|SK)[A-Za-z0-9_-]{12}", None),
    "weak_secret": (r"(?:\G|(?<![A-Za-z0-9/+]))[A-Za-z0-9/+]{40}+(?![A-Za-z0-9/+=])", "[A-Za-z0-9/+]{40}", lambda v: v.rlike("[0-9]") & v.rlike("[A-Z]") & v.rlike("[a-z]")),
    "weak_endpoint": (r"(?:https?|wss?|amqps?|postgres(?:ql)?|mysql|redis|mongodb)://[^\x00-\x20\"'<>]+", "://", None),
}
KINDS = BASE | WEAK
#: What may complete a weak part: its own kind first, then the kinds of the other roles.
SECRETS, OWNERS = ("assign", "weak_secret", "hex"), ("access", "weak_id", "weak_endpoint")
NEEDS = {"weak_id": SECRETS, "weak_secret": OWNERS, "weak_endpoint": SECRETS}


def find_secrets(documents: DataFrame, scope: int = 300) -> DataFrame:
    """documents with secrets added: spans (kind, ord, start, end, value, score), by start and kind; positions count code points.

    Extra columns stay; one named secrets is replaced. Rows are taken one by one, so repeated rows and null ids have their own
    spans; an empty table stays empty. Long texts, and many parts in one, cost time nearly in proportion: parts and their complements
    are joined by sorted sweeps.
    """
    plain, back = set_aside(documents, ("doc_id", "text"), ("secrets",))
    df = plain.withColumn("_text", F.coalesce("text", F.lit("")))
    df = df.withColumns({f"_{k}": matches("_text", p, F.col("_text").rlike(gate)) for k, (p, gate, _) in KINDS.items()})
    df = df.withColumns({f"_{k}": spans_of("_text", f"_{k}", p, k, i, keep, 1.0 if k in BASE else 0.5) for i, (k, (p, _, keep)) in enumerate(KINDS.items())})
    base = F.concat(*[F.col(f"_{k}") for k in BASE])

    def linked(kind: str) -> Column:
        own, others = F.col(f"_{kind}"), F.concat(*[F.col(f"_{k}") for k in NEEDS[kind]])
        beside = let(others, lambda o: near(own, o, scope))
        inside = let(base, lambda b: covered(own, b))
        return F.when((F.size(own) > 0) & (F.size(others) > 0), chosen(own, F.zip_with(beside, inside, lambda x, y: x & ~y))).otherwise(F.array().cast(SPAN))

    return back(df.withColumn("secrets", by_start(F.concat(base, *[linked(k) for k in WEAK]))))
