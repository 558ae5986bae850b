"""Personal data by weak supervision.

Candidate spans of four kinds come from strict patterns (the base, always
kept) and from looser ones (obfuscated addresses, national phone forms, card
numbers with a wrong check digit). Three labelers vote on each candidate: the
strict pattern with its check (which abstains on loose forms but for a wrong
check digit), a gazetteer (name endings, issuer and area digits), and cue
words shortly before the span; each says yes, no or abstains.
Expectation-maximisation over the table of vote patterns estimates how
reliable each labeler is (Dawid and Skene), and its posteriors are the soft
labels of the final span classifier, a naive Bayes model over span features.
Loose candidates that it accepts are added to the base.

Only DataFrame and SQL functions run here. Texts are read once: candidates,
which hold no text, are written to the shared folder, and all counting runs on
them. The table of vote patterns has at most 4 * 27 rows.

Defined cases: a null or empty text has no spans; a null id is kept; repeated
rows give a row each; without candidates nothing is estimated or added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, found, let, part, running, stored, whole

KINDS = ("email", "ip", "card", "phone")
#: (pattern, cheap test, check of a match x). Possessive forms of the given patterns: the classes that follow
#: a run never contain its characters, so nothing that the plain forms match is lost, and long runs stay linear.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
DIGITS = "regexp_replace(x.m, '[^0-9]', '')"
LUHN = f"""aggregate(transform(sequence(1, length({DIGITS})),
    i -> cast(substring(reverse({DIGITS}), i, 1) as int) * (2 - i % 2)), 0L, (a, d) -> a + d div 10 + d % 10) % 10 = 0"""
BASE = {
    "email": (EMAIL, "contains(text, '@')", "true"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "text rlike '[0-9]\\\\.[0-9]'",
           "forall(split(x.m, '\\\\.'), p -> length(ltrim('0', p)) <= 3 and cast(concat('0', ltrim('0', p)) as int) <= 255)"),
    "card": (r"[0-9](?:[\x20-]?[0-9]){12,}+", "text rlike '[0-9][ -]?[0-9]'", f"length({DIGITS}) <= 19 and {LUHN}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "contains(text, '+')", f"length({DIGITS}) between 9 and 15"),
}
LOOSE = {
    "email": (r"[A-Za-z0-9_%+-]++\x20?[(\[](?:at|AT)[)\]]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[(\[](?:dot|DOT)[)\]])\x20?[A-Za-z0-9-]++)+",
              "text rlike '[(\\\\[](at|AT)[)\\\\]]'", "true"),
    "card": (BASE["card"][0], BASE["card"][1], f"length({DIGITS}) between 13 and 16 and not ({LUHN})"),
    "phone": (r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])", "text rlike '[0-9]{3}[ .-][0-9]{4}'", "true"),
}
#: The strict labeler's vote on a loose candidate: a wrong check digit is a no, other forms it cannot judge.
STRICT = {"email": -1, "card": 0, "phone": -1}
#: Gazetteers: what a genuine span of the kind carries.
GAZETTEER = {
    "email": r"(?i)\\.(com|org|net|edu|gov|io|info|co|de|fr|es|uk|eu)$",
    "ip": r"^(?!0|127\\.|255\\.)",
    "card": r"^(4|5[1-5]|2[2-7]|3[47]|6)",
    "phone": r"^(\\+[1-9]|\\(?[2-9])",
}
#: Cue words looked for in the characters before a span.
CUES = {
    "email": r"(?i)(mail|contact|write to|courriel|correo)[^a-z]*$",
    "ip": r"(?i)(\\bip|host|server|address|adresse|addr)[^a-z]*$",
    "card": r"(?i)(card|visa|carte|karte|tarjeta|credit)[^a-z]*$",
    "phone": r"(?i)(phone|tel|call|fax|mobile|appel|anruf)[^a-z]*$",
}
CUE_CHARS = 24
ROUNDS, ACCEPT = 10, 0.9


def candidates_sql() -> str:
    """SQL for the candidates of a column ``text``: kind, s, e, base, and the votes (1 yes, 0 no, -1 abstains)."""
    parts = []
    for base, rules in ((1, BASE), (0, LOOSE)):
        for kind, (pattern, hint, check) in rules.items():
            near = part("cut", f"greatest(x.s - {CUE_CHARS}, 0)", "x.s")
            gaz = f"case when x.m rlike '{GAZETTEER[kind]}' then 1 else 0 end"
            cue = f"case when {near} rlike '{CUES[kind]}' then 1 else -1 end"
            cands = (f"transform(ms, x -> named_struct('kind', {KINDS.index(kind)}, 's', x.s, 'e', x.e, 'base', {base}, "
                     f"'v1', {STRICT[kind] if not base else 1}, 'v2', {gaz}, 'v3', {cue}))")
            hits = let("ms", f"filter({found('text', pattern)}, x -> {check})", f"case when size(ms) > 0 then {let('cut', blocks('text'), cands)} else {NO_CANDS} end")
            parts.append(f"case when {hint} then {hits} else {NO_CANDS} end")
    return f"concat({', '.join(parts)})"


def candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc id and ``cands`` of each document."""
    text = docs.select(F.col(id_col).alias("doc_id"), whole(F.col(text_col)).alias("text"))
    return text.select("doc_id", F.expr(candidates_sql()).alias("cands"))


NO_CANDS = "cast(array() as array<struct<kind:int,s:int,e:int,base:int,v1:int,v2:int,v3:int>>)"
VOTES = ("v1", "v2", "v3")


def reliabilities(patterns: DataFrame) -> tuple[DataFrame, list[dict]]:
    """EM over counted vote patterns. Returns the patterns with posterior ``p`` and the parameters of every round.

    Each round is one aggregation of the bounded pattern table: the E-step is
    a column built from the last parameters, the M-step their weighted counts.
    The first posterior is the share of yes among the votes cast. An abstention
    says nothing, and a vote never counts against what it says, even where the
    estimate makes the labeler worse than chance.
    """
    cast = " + ".join(f"if({v} >= 0, 1, 0)" for v in VOTES)
    p, rounds = f"(({' + '.join(f'if({v} = 1, 1, 0)' for v in VOTES)}) + 0.5D) / ({cast} + 1D)", []
    for _ in range(ROUNDS):
        step = patterns.withColumn("p", F.expr(p))
        sums = ["sum(n * p) as yes", "sum(n * (1 - p)) as no"] + [
            f"sum(if({v} = {x}, n * {w}, 0)) as {v}_{x + 1}_{z}" for v in VOTES for x in (-1, 0, 1) for z, w in ((1, "p"), (0, "(1 - p)"))]
        got = step.selectExpr(*sums).first().asDict()
        rounds.append(got)
        odds = {}
        for v in VOTES:
            for x in (1, 2):  # no, yes
                no, yes = ((got[f"{v}_{x}_{z}"] + 1) / (got["yes" if z else "no"] + 3) for z in (0, 1))
                odds[v, x] = (1.0, 1.0) if (yes < no) == (x == 2) else (no, yes)
        like = lambda z: " * ".join([f"{(got['yes' if z else 'no'] + 1) / (got['yes'] + got['no'] + 2)!r}D"] + [
            f"element_at(array(1D, {odds[v, 1][z]!r}D, {odds[v, 2][z]!r}D), {v} + 2)" for v in VOTES])
        p = f"({like(1)}) / (({like(1)}) + ({like(0)}))"
    return patterns.withColumn("p", F.expr(p)), rounds


PATTERN = ("kind", *VOTES)
#: Kind and gazetteer go together; being base or not is no feature, a failed check is.
FEATURES = {"kind_v2": "{x}kind * 2 + {x}v2", "failed": "if({x}v1 = 0, 1, 0)", "v3": "{x}v3"}


def classifier(labelled: DataFrame) -> str:
    """Naive Bayes trained on the soft labels, as SQL for a candidate's probability (fields of ``x``)."""
    total = labelled.selectExpr("sum(n * p) as yes", "sum(n * (1 - p)) as no").first()
    stacked = labelled.selectExpr("n", "p", f"stack({len(FEATURES)}, {', '.join(f"'{f}', {sql.format(x='')}" for f, sql in FEATURES.items())}) as (f, v)")
    cells = stacked.groupBy("f", "v").agg(F.expr("sum(n * p) as yes"), F.expr("sum(n * (1 - p)) as no")).collect()  # some dozens
    odds = f"ln({total.yes + 1!r}D / {total.no + 1!r}D)"
    for f, sql in FEATURES.items():
        cases = " ".join(f"when {r.v} then {(r.yes + 1) / (total.yes + 20)!r}D / {(r.no + 1) / (total.no + 20)!r}D" for r in cells if r.f == f)
        odds += f" + ln(case {sql.format(x='x.')} {cases} else 1D end)"
    return f"1D / (1D + exp(-({odds})))"


def apart(cands: str) -> str:
    """SQL: the base candidates of an array and the loose ones that overlap none of them.

    In order of their starts, a loose candidate meets a base one before it if
    the furthest end so far lies behind its start, and one after it if the next start
    lies before its end.
    """
    before = running("transform(o, y -> if(y.x.base = 1, y.x.e, 0))", "greatest(v, {w})")
    after = running("transform(o, y -> if(y.x.base = 1, y.x.s, 2147483647))", "least(v, {w})", ahead=True)
    kept = "transform(filter(o, (y, i) -> y.x.base = 1 or (behind[i] <= y.s and next[i] >= y.x.e)), y -> y.x)"
    order = f"sort_array(transform({cands}, x -> named_struct('s', x.s, 'loose', 1 - x.base, 'x', x)))"
    return let("o", order, let("behind", before, let("next", after, kept)))


def estimate(cands: DataFrame) -> str:
    """Vote reliabilities, then the classifier: SQL for the probability of a candidate ``x``."""
    # a loose candidate inside a base span says nothing that the base does not
    alone = F.expr(f"case when exists(cands, x -> x.base = 0) then {apart('cands')} else cands end")
    patterns = stored(cands.select(F.explode(alone).alias("c")).groupBy(*[F.col(f"c.{f}").alias(f) for f in PATTERN]).agg(F.count(F.lit(1)).alias("n")).coalesce(1), "pii-votes")
    return "0D" if patterns.isEmpty() else classifier(reliabilities(patterns)[0])  # at most 4 * 27 rows


def accepted_sql(probability: str, accept: float) -> str:
    """SQL: the base candidates of ``cands`` and the loose ones accepted outside those of their kind, sorted."""
    each = apart("filter(taken, x -> x.kind = k)")
    taken = let("taken", f"filter(cands, x -> x.base = 1 or ({probability}) >= {accept}D)",
                f"case when exists(taken, x -> x.base = 0) then flatten(transform(sequence(0, {len(KINDS) - 1}), k -> {each})) else taken end")
    return f"sort_array(transform({taken}, x -> named_struct('kind', x.kind, 's', x.s, 'e', x.e, 'base', x.base)))"


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """doc id and ``spans``: sorted structs (kind index, s, e, base) of the base spans and the accepted loose ones."""
    cands = stored(candidates(docs, id_col, text_col), "pii-candidates")
    return cands.select("doc_id", F.expr(accepted_sql(estimate(cands), accept)).alias("spans"))


def masked(docs: DataFrame, text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """``docs`` with every span in ``text_col`` replaced by its kind in brackets; other columns stay, null texts too."""
    cands = stored(docs.select(whole(F.col(text_col)).alias("text")).select(F.expr(candidates_sql()).alias("cands")).where(F.size("cands") > 0), "pii-candidates")
    probability = estimate(cands)
    held = docs.select(F.struct("*").alias("row"), whole(F.col(text_col)).alias("text")).withColumn("cands", F.expr(candidates_sql()))
    spans = held.withColumn("spans", F.expr(accepted_sql(probability, accept)))
    text = F.when(F.col("row")[text_col].isNotNull(), F.when(F.size("spans") > 0, F.expr(mask("text", "spans"))).otherwise(F.col("text")))
    return spans.select(*[text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])


def pii_digest(spans: DataFrame) -> DataFrame:
    """Base counts, the digest of the base spans, and all spans as text."""
    name = f"element_at(array({', '.join(repr(k) for k in KINDS)}), x.kind + 1)"
    joined = lambda kept: F.expr(f"array_join(transform({kept}, x -> concat({name}, ':', x.s, ':', x.e)), ',')")
    count = lambda i: F.expr(f"cast(size(filter(spans, x -> x.base = 1 and x.kind = {i})) as bigint)").alias(f"n_{KINDS[i]}")
    return spans.select("doc_id", *[count(i) for i in range(4)],
                        F.sha2(joined("filter(spans, x -> x.base = 1)"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def mask(text: str, spans: str) -> str:
    """SQL: ``text`` with every span of the sorted array ``spans`` replaced by its kind in brackets, overlapping ones by the first's."""
    name = f"element_at(array({', '.join(repr(k) for k in KINDS)}), x.kind + 1)"
    order = f"array_sort(transform({spans}, x -> named_struct('s', x.s, 'e', x.e, 'kind', x.kind)))"
    done = running("transform(o, x -> x.e)", "greatest(v, {w})")
    at = "coalesce(get(done, i - 1), 0)"
    pieces = f"transform(o, (x, i) -> case when x.s < {at} then '' else concat({part('cut', at, 'x.s')}, '[', {name}, ']') end)"
    rest = part("cut", "array_max(done)", f"length({text})")
    return let("cut", blocks(text), let("o", order, let("done", done, f"concat(array_join({pieces}, ''), {rest})")))
