"""Personal data by weak supervision, in DataFrame operations only.

Base spans follow fixed patterns and checks (email, ip, card, phone). Beyond them, looser patterns propose candidates of
three further kinds: `secret` (long random tokens), `id` (grouped numbers such as national ids and phones without a
country code) and `name` (two capitalised words). Four labelers vote on each candidate with -1, 0 or 1:

* shape: the strict form of the kind,
* gazetteer: known given and family names, numbers that the issuing plan allows, issuer prefixes of keys,
* left context: cue words shortly before the span,
* content: digit and letter statistics of the span.

Votes are counted over all documents; cells of kind and votes number 3 * 3**4 and, times the length and neighbour
features, 2187 at most. Expectation-maximisation over that table estimates each labeler's reliability and each cell's probability. The
final classifier, naive Bayes over the votes and the features that no labeler sees, is trained on those soft labels and
scores every candidate; candidates that it accepts and that overlap no base span are added.

Defined results: a null text counts as empty; an empty text has no spans (the digest of nothing); repeated rows and equal
texts give equal results; an empty table gives an empty result; null ids and extra columns pass through untouched.
Positions count code points, ends are exclusive.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytoframe.llm.common import checkpoint

# Java forms of the base patterns. Quantifiers that can never give a character back are possessive, which keeps the
# matcher's stack flat on long runs; a match that could only repeat a failed attempt from further right is skipped by a
# look-behind, which keeps it linear.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE_KINDS = ("email", "ip", "card", "phone")

# Candidate patterns of the added kinds.
SECRET = r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{20,}+"
NUMBER = r"(?<![0-9A-Za-z.+-])(?:\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4})(?![0-9A-Za-z-])"
NAME = r"(?<![\p{L}])(?:Mr|Mrs|Ms|Dr|Prof|[A-Z][a-z]{1,15})\.? [A-Z][a-z]{1,15}(?![\p{L}])"
ADDED_KINDS = ("secret", "id", "name")

# Frequent given and family names of several countries, the default gazetteer; callers pass a longer one.
GIVEN_NAMES = (
    "James John Robert Michael William David Richard Joseph Thomas Charles Christopher Daniel Matthew Anthony Mark Donald Steven Paul Andrew Joshua "
    "Kenneth Kevin Brian George Timothy Ronald Edward Jason Jeffrey Ryan Jacob Gary Nicholas Eric Jonathan Stephen Larry Justin Scott Brandon "
    "Benjamin Samuel Gregory Alexander Patrick Frank Raymond Jack Dennis Jerry Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen "
    "Lisa Nancy Betty Margaret Sandra Ashley Kimberly Emily Donna Michelle Carol Amanda Dorothy Melissa Deborah Stephanie Rebecca Sharon Laura Cynthia "
    "Hans Peter Klaus Wolfgang Stefan Andreas Anna Maria Ursula Sabine Jean Pierre Michel Philippe Marie Sophie Jose Juan Carlos Luis Carmen Ana "
    "Giovanni Giuseppe Giulia Ivan Olga Natalia Ahmed Mohammed Fatima Wei Ming Hiroshi Yuki Raj Priya"
).split()
FAMILY_NAMES = (
    "Smith Johnson Williams Brown Jones Garcia Miller Davis Rodriguez Martinez Hernandez Lopez Gonzalez Wilson Anderson Taylor Moore Jackson Martin Lee "
    "Perez Thompson Harris Sanchez Clark Ramirez Lewis Robinson Walker Young Allen King Wright Scott Torres Nguyen Hill Flores Adams Nelson "
    "Schmidt Schneider Fischer Weber Meyer Wagner Becker Dubois Durand Leroy Moreau Rossi Russo Ferrari Silva Santos Ivanov Petrov Kim Patel Singh Tanaka Suzuki Chen Wang"
).split()
#: Numbers that the issuing plans allow: of social security (no area 000, 666 or 9xx, no group 00, no serial 0000) and of
#: telephones (area and exchange from 2, no area x9x, no exchange x11 and none of the fictitious 555-01xx).
ISSUED = r"^(?:(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}|\(?[2-9][0-8][0-9](?:\) ?|-)(?!555-01)[2-9](?!11)[0-9]{2}-[0-9]{4})$"
#: Words that make two capitalised words a place, a date or a heading: the content labeler never votes for a name, only against.
COMMON = (
    r"\b(?:Street|Road|Avenue|Square|City|Town|County|Valley|Lake|River|Mountain|Island|Bay|Harbor|Bridge|Station|Hotel|Palace|Museum|Park|Church|School|College|University|Hospital"
    r"|Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday|Morning|Evening|January|February|April|June|July|August|September|October|November|December"
    r"|Company|Bank|Council|Court|Act|Chapter|Section|New|North|South|East|West|Saint|United|Royal|National|The|This|That|With|From|And)\b"
)
TITLES = ("Mr", "Mrs", "Ms", "Dr", "Prof")
#: Words that announce a span of each kind, and words that speak against one.
CUES = {
    "secret": r"(?:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key|bearer|private[_-]?key)",
    "id": r"(?:ssn|social security|phone|tel|call|fax|mobile|passport|tax id)",
    "name": r"(?:\bmr|\bmrs|\bms|\bdr|\bprof|name is|signed|sincerely|contact|author)",
}
AGAINST = {"secret": r"(?:https?://|www\.|isbn|version)", "id": r"(?:isbn|issn|version|page|order|invoice)", "name": r"(?:[.!?:|]|\n)\s*$"}
#: Characters before a span in which the left-context labeler looks.
CONTEXT = 24
LABELERS = ("shape", "gazetteer", "left", "content")
#: A candidate is added where the classifier's probability reaches this.
ACCEPT = 0.9


#: Array items that one fold walks; folds append to arrays, so a block costs its square and all blocks together cost no
#: more than the number of items times this.
_FOLD = 128


def _once(value: Column, use) -> Column:
    """Evaluate `value` once and hand it to `use`."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _blocks(items: Column, size: int | Column = _FOLD) -> Column:
    """The items in consecutive runs of `size`; one empty run where there are none."""
    last = F.greatest(F.floor((F.size(items) - 1) / size), F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(items, b * size + 1, size if isinstance(size, Column) else F.lit(size)))


def _before(blocks: Column, zero: Column, join, kind: str) -> Column:
    """For each block the fold of all blocks before it: `join` must not care how the items are bracketed."""
    totals = F.transform(blocks, lambda b: F.aggregate(b, zero, join))
    start = F.struct(zero.alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
    both = lambda acc, n: F.struct(merge(acc["at"], n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
    merge = _MERGES[kind]
    return F.aggregate(totals, start, both, lambda acc: acc["out"])


#: Of a place in a text: the code points before it and the last of them, for the left context.
_PLACE = "struct<n:int,tail:string>"


def _walked(p: Column, piece: Column) -> Column:
    return F.struct((p["n"] + F.length(piece)).alias("n"), F.right(F.concat(p["tail"], piece), F.lit(CONTEXT)).alias("tail"))


_MERGES = {
    "int": lambda x, y: x + y,
    "bigint": lambda x, y: F.greatest(x, y),
    _PLACE: lambda x, y: F.struct((x["n"] + y["n"]).alias("n"), F.right(F.concat(x["tail"], y["tail"]), F.lit(CONTEXT)).alias("tail")),
}


def _spans(text: Column, pattern: str, kind: str, check, around: bool = False) -> Column:
    """array<struct<kind, start, stop, m>> of the pattern's leftmost non-overlapping matches; those that fail the check are dropped.

    The text between matches comes from split, the matches from regexp_extract_all; positions are running sums of their
    lengths, first over blocks of matches, then inside each block. With `around` each span has the CONTEXT code points
    before it (left) and the one behind it (after), taken from the pieces too, so that nothing walks the text again.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    span = f"array<struct<start:int,stop:int,m:string{',left:string,after:string' if around else ''}>>"

    def walk(block: Column, offset: Column) -> Column:
        def step(acc, z):
            start = acc["at"] + F.length(z["gap"])
            return _once(start, lambda s: F.struct((s + F.length(z["hit"])).alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("start"), (s + F.length(z["hit"])).alias("stop"), z["hit"].alias("m")))).alias("out")))

        def step_around(acc, z):
            def put(at):
                stop = at["n"] + F.length(z["hit"])
                one = F.struct(at["n"].alias("start"), stop.alias("stop"), z["hit"].alias("m"), at["tail"].alias("left"), z["after"].alias("after"))
                return F.struct(_walked(at, z["hit"]).alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

            return _once(_walked(acc["at"], z["gap"]), put)

        return F.aggregate(block, F.struct(offset.alias("at"), F.array().cast(span).alias("out")), step_around if around else step, lambda acc: acc["out"])

    def placed(blocks: Column) -> Column:
        if around:
            offsets = _before(blocks, F.struct(F.lit(0).alias("n"), F.lit("").alias("tail")), lambda p, z: _walked(_walked(p, z["gap"]), z["hit"]), _PLACE)
        else:
            offsets = _before(blocks, F.lit(0), lambda n, z: n + F.length(z["gap"]) + F.length(z["hit"]), "int")
        return F.flatten(F.zip_with(blocks, offsets, walk))

    def paired(hit: Column) -> Column:
        if around:
            # behind a match stands the next gap, or where that is empty the next match, or nothing
            behind = F.zip_with(F.slice(gaps, F.lit(2), F.size(hit)), F.slice(hit, F.lit(2), F.size(hit)), lambda g, h: F.substring(F.when(g == "", F.coalesce(h, F.lit(""))).otherwise(g), 1, 1))
            ends = F.zip_with(hit, behind, lambda h, a: F.struct(h.alias("hit"), a.alias("after")))
            pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(hit)), ends, lambda g, e: F.struct(g.alias("gap"), e["hit"].alias("hit"), e["after"].alias("after")))
        else:
            pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(hit)), hit, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
        return F.when(F.size(hit) == 0, F.array().cast(span)).otherwise(_once(pairs, lambda z: _once(_blocks(z), placed)))

    found = F.filter(_once(hits, paired), lambda s: check(s["m"]))
    more = ("left", "after") if around else ()
    return F.transform(found, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["m"].alias("m"), *[s[c].alias(c) for c in more]))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _octets_fit(m: Column) -> Column:
    small = lambda p: (F.length(p) <= 3) & (F.when(F.length(p) <= 3, F.concat(F.lit("0"), p).cast("int")) <= 255)
    return F.forall(F.transform(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+", "")), small)


CHECKS = {
    "email": lambda m: F.lit(True),
    "ip": _octets_fit,
    "card": lambda m: F.length(_digits(m)).between(16, 19) & F.call_function("luhn_check", _digits(m)),
    "phone": lambda m: F.length(_digits(m)).between(8, 15),
}
_PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
_BARE = "array<struct<kind:string,start:int,stop:int>>"
_SPAN = "array<struct<kind:string,start:int,stop:int,m:string>>"
_AROUND = "array<struct<kind:string,start:int,stop:int,m:string,left:string,after:string>>"


def _none(kind: str = _SPAN) -> Column:
    return F.array().cast(kind)


def _bare(s: Column) -> Column:
    return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))


def base_spans(text: Column) -> Column:
    """All base spans in order of kind, then start. Cheap tests keep most texts out of the matcher."""
    digit = text.rlike("[0-9]")
    needs = {"email": text.contains("@") & text.contains("."), "ip": digit & text.rlike(r"[0-9]\.[0-9]"), "card": digit, "phone": text.contains("+")}
    return F.concat(*[F.when(needs[k], _spans(text, _PATTERNS[k], k, CHECKS[k])).otherwise(_none()) for k in BASE_KINDS])


def candidate_spans(text: Column) -> Column:
    """Candidates in order of kind, then start, each with its surroundings."""
    some = lambda m: F.lit(True)
    mixed = lambda m: m.rlike("[0-9]") & m.rlike("[A-Za-z]")
    return F.concat(
        F.when(text.rlike("[A-Za-z0-9_+/=-]{20}"), _spans(text, SECRET, "secret", mixed, True)).otherwise(_none(_AROUND)),
        F.when(text.rlike("[0-9]{3}[-)]"), _spans(text, NUMBER, "id", some, True)).otherwise(_none(_AROUND)),
        F.when(text.rlike("[A-Z][a-z]+\\.? [A-Z][a-z]"), _spans(text, NAME, "name", some, True)).otherwise(_none(_AROUND)),
    )


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit(1)).when(no, F.lit(-1)).otherwise(F.lit(0))


@dataclass(frozen=True)
class Gazetteer:
    """Names that the gazetteer labeler knows, looked up by hash, so that there may be many thousands."""

    given: tuple[str, ...] = tuple(GIVEN_NAMES)
    family: tuple[str, ...] = tuple(FAMILY_NAMES)

    def votes(self, name: Column) -> Column:
        """1 for a known given name (behind a title too) or a known family name, 0 for a title with an unknown one, else -1."""
        first, last = F.rtrim(F.substring_index(name, " ", 1), F.lit(".")), F.substring_index(name, " ", -1)
        titled = first.isin(*TITLES)
        known = first.isin(*self.given) | last.isin(*self.family) | (titled & last.isin(*self.given))
        return _vote(known, ~titled)


#: The names of general knowledge above.
KNOWN = Gazetteer()


def labelled(spans: Column, known: Gazetteer = KNOWN) -> Column:
    """Candidates with their votes (v0..v3) and features (len, next): array<struct>."""

    def one(s: Column) -> Column:
        kind, m = s["kind"], s["m"]
        left, after = F.lower(s["left"]), s["after"]
        by = lambda secret, number, name: F.when(kind == "secret", secret).when(kind == "id", number).otherwise(name)
        shape = by(
            _vote(m.rlike(r"^(?:[0-9a-f]{32,}|[0-9A-F]{32,}|[A-Za-z0-9_+/-]{36,}={0,2}|[A-Z0-9]{20})$"), ~m.rlike("[0-9].*[0-9].*[0-9]")),
            _vote(m.rlike(r"^(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|\([0-9]{3}\).*)$"), m.rlike("^000|^\\(000")),
            _vote(m.rlike(r"^(?:Mr|Mrs|Ms|Dr|Prof)\.? "), m.rlike(r"^(?:The|And|Of|In|On|A|La|De|Der|Die|El|Le|Les) ")),
        )
        gazetteer = by(_vote(m.rlike(r"^(?:sk|pk|ghp|xox[bp]|AKIA|eyJ)"), m.rlike(r"(?:__|--|==.|//)")), _vote(m.rlike(ISSUED), ~m.rlike(ISSUED)), known.votes(m))
        cue = by(_vote(left.rlike(CUES["secret"]), left.rlike(AGAINST["secret"])), _vote(left.rlike(CUES["id"]), left.rlike(AGAINST["id"])), _vote(left.rlike(CUES["name"]), left.rlike(AGAINST["name"]) | (s["start"] == 0)))
        distinct = F.size(F.array_distinct(F.split(m, "")))
        digits = F.length(_digits(m)).cast("double") / F.length(m)
        content = by(_vote((distinct >= 10) & digits.between(0.2, 0.95), (digits < 0.1) | (distinct < 6)), _vote(distinct >= 6, distinct < 4), _vote(F.lit(False), (distinct < 5) | m.rlike(COMMON)))
        size = F.when(F.length(m) < 16, 0).when(F.length(m) < 36, 1).otherwise(2)
        follow = F.when(after.rlike("[\"'>]"), 0).when((after == "") | after.rlike(r"\s"), 1).otherwise(2)
        return F.struct(kind.alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), shape.alias("v0"), gazetteer.alias("v1"), cue.alias("v2"), content.alias("v3"), size.alias("len"), follow.alias("next"))

    return F.transform(spans, one)


@dataclass
class SpanModel:
    """Log odds of the final classifier by kind, and the labelers' estimated reliabilities behind it."""

    prior: dict[str, float] = field(default_factory=dict)
    weights: dict[str, dict[str, dict[int, float]]] = field(default_factory=dict)
    reliability: dict[str, dict[str, float]] = field(default_factory=dict)


FEATURES = ("v0", "v1", "v2", "v3", "len", "next")


def fit_cells(cells: list[dict], rounds: int = 50) -> SpanModel:
    """EM over the counted cells (kind, v0..v3, len, next, n), then naive Bayes on the soft labels.

    Labelers are taken as independent given the truth: labeler j votes right with reliability a_j whenever it votes.
    Reliabilities start at 0.8, stay within [0.55, 0.99] so that labels cannot swap, and the share of true spans is
    estimated along. Kinds without candidates have no entry and nothing is added for them.
    """
    model = SpanModel()
    votes = FEATURES[:4]
    for kind in ADDED_KINDS:
        own = [c for c in cells if c["kind"] == kind]
        total = sum(c["n"] for c in own)
        if not total:
            continue
        acc, share, post = [0.8] * 4, 0.3, [0.5] * len(own)
        for _ in range(rounds):
            for i, c in enumerate(own):
                odds = math.log(share / (1 - share))
                for j, v in enumerate(votes):
                    odds += c[v] * math.log(acc[j] / (1 - acc[j]))
                post[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
            share = min(0.95, max(0.001, (sum(p * c["n"] for p, c in zip(post, own)) + 0.3) / (total + 1)))
            for j, v in enumerate(votes):
                right = sum(c["n"] * (p if c[v] > 0 else 1 - p) for p, c in zip(post, own) if c[v])
                voted = sum(c["n"] for c in own if c[v])
                acc[j] = min(0.99, max(0.55, (right + 8) / (voted + 10)))
        yes, no = sum(p * c["n"] for p, c in zip(post, own)) + 1, sum((1 - p) * c["n"] for p, c in zip(post, own)) + 1
        model.prior[kind] = math.log(yes / no)
        model.reliability[kind] = dict(zip(LABELERS, acc))
        model.weights[kind] = {}
        for f in FEATURES:
            values = (-1, 0, 1) if f in votes else (0, 1, 2)
            model.weights[kind][f] = {
                v: math.log((sum(p * c["n"] for p, c in zip(post, own) if c[f] == v) + 1) / (yes + 2)) - math.log((sum((1 - p) * c["n"] for p, c in zip(post, own) if c[f] == v) + 1) / (no + 2))
                for v in values
            }
    return model


def count_cells(cands: DataFrame, column: str = "cands") -> list[dict]:
    """Counts of the vote and feature cells over all candidates, 2187 rows at most."""
    # explode() would add a filter on the array's size, which computes the candidates a second time
    one = cands.select(F.explode_outer(column).alias("c")).where("c is not null").select("c.kind", *[F.col(f"c.{f}") for f in FEATURES])
    return [r.asDict() for r in one.groupBy("kind", *FEATURES).agg(F.count("*").alias("n")).orderBy("kind", *FEATURES).collect()]


def score(model: SpanModel, c: Column) -> Column:
    """Probability of a candidate under the final classifier; 0 for kinds that it has not seen."""
    odds = F.lit(-30.0)
    for kind in model.prior:
        total = F.lit(model.prior[kind])
        for f in FEATURES:
            by = model.weights[kind][f]
            least = min(by)
            total = total + F.element_at(F.array(*[F.lit(by[v]) for v in sorted(by)]), c[f] - least + 1)
        odds = F.when(c["kind"] == kind, total).otherwise(odds)
    return 1 / (1 + F.exp(-odds))


def _clear(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others, by kind as listed, then start.

    A span overlaps one of those that start before its stop if the largest stop among them lies beyond its start: one
    running maximum over both sorted together, at equal places a span's stop before another's start.
    """
    item = lambda at, tag, s: F.struct(at.alias("at"), F.lit(tag).alias("tag"), s["start"].cast("bigint").alias("from"), s["stop"].cast("bigint").alias("to"), s["kind"].alias("kind"))
    every = lambda x: F.sort_array(F.concat(F.transform(x["s"], lambda s: item(s["stop"], 0, s)), F.transform(x["o"], lambda s: item(s["start"], 1, s))))
    reach = lambda most, z: F.when(z["tag"] == 1, F.greatest(most, z["to"])).otherwise(most)
    kept = "array<struct<rank:int,start:int,stop:int,kind:string>>"

    def walk(block: Column, most: Column) -> Column:
        def step(acc, z):
            rank = F.when(z["kind"] == "secret", 0).when(z["kind"] == "id", 1).otherwise(2)
            one = F.array(F.struct(rank.alias("rank"), z["from"].cast("int").alias("start"), z["to"].cast("int").alias("stop"), z["kind"].alias("kind")))
            free = (z["tag"] == 0) & (acc["at"] <= z["from"])
            return F.struct(reach(acc["at"], z).alias("at"), F.when(free, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

        return F.aggregate(block, F.struct(most.alias("at"), F.array().cast(kept).alias("out")), step, lambda acc: acc["out"])

    zero = F.lit(0).cast("bigint")
    merged = lambda xs: _once(_blocks(xs), lambda bs: F.flatten(F.zip_with(bs, _before(bs, zero, reach, "bigint"), walk)))
    clear = lambda x: F.transform(F.sort_array(_once(every(x), merged)), _bare)
    return _once(F.struct(spans.alias("s"), others.alias("o")), lambda x: F.when((F.size(x["s"]) == 0) | (F.size(x["o"]) == 0), x["s"]).otherwise(clear(x)))


def accepted(model: SpanModel, base: Column, cands: Column) -> Column:
    """Added spans: accepted candidates that overlap neither a base span nor an accepted one of an earlier kind."""
    sure = F.transform(F.filter(cands, lambda c: score(model, c) >= ACCEPT), _bare)

    def of(mine: Column) -> Column:
        by = lambda *kinds: F.filter(mine, lambda c: c["kind"].isin(*kinds))
        kept = F.concat(by("secret"), _clear(by("id"), by("secret")), _clear(by("name"), by("secret", "id")))
        return F.when(F.size(mine) == 0, mine).otherwise(kept)

    return _once(sure, lambda c: _once(_clear(c, base), of))


def examined(docs: DataFrame, text: str = "text", known: Gazetteer = KNOWN) -> DataFrame:
    """docs with base (array<struct<kind,start,stop>>) and cands (with votes)."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    found = docs.withColumns({"__base": base_spans(t), "__cands": candidate_spans(t)})
    return found.withColumns({"base": F.transform("__base", _bare), "cands": labelled(F.col("__cands"), known)}).drop("__base", "__cands")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by <kind>; overlapping spans merge into the first.

    Substrings are counted from a string's start, so the text is first cut into as many parts as each has spans (about
    the square root of their number), then each part into its pieces.
    """
    ordered = lambda found: F.sort_array(F.transform(found, lambda s: F.struct(s["start"].cast("bigint").alias("start"), s["stop"].cast("bigint").alias("stop"), s["kind"].alias("kind"))))
    reach = lambda most, s: F.greatest(most, s["stop"])
    zero = F.lit(0).cast("bigint")
    cut = "array<struct<at:bigint,start:bigint,stop:bigint,kind:string>>"

    def walk(block: Column, most: Column) -> Column:
        def step(acc, s):
            one = F.array(F.struct(acc["at"].alias("at"), s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind")))
            return F.struct(reach(acc["at"], s).alias("at"), F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], one)).alias("out"))

        return F.aggregate(block, F.struct(most.alias("at"), F.array().cast(cut).alias("out")), step, lambda acc: acc["out"])

    def pieces(part: Column) -> Column:
        def of(x: Column) -> Column:
            return F.array_join(F.transform(x["part"], lambda s: F.concat(x["text"].substr((s["at"] - x["from"] + 1).cast("int"), (s["start"] - s["at"]).cast("int")), F.lit("<"), s["kind"], F.lit(">"))), "")

        first, last = F.element_at(part, 1)["at"], F.element_at(part, -1)["start"]
        return _once(F.struct(part.alias("part"), first.alias("from"), text.substr((first + 1).cast("int"), (last - first).cast("int")).alias("text")), of)

    def put(cuts: Column) -> Column:
        many = F.greatest(F.ceil(F.sqrt(F.size(cuts))), F.lit(16)).cast("int")
        return F.array_join(F.transform(_blocks(cuts, many), pieces), "")

    cuts = lambda found: _once(ordered(found), lambda xs: _once(_blocks(xs), lambda bs: F.flatten(F.zip_with(bs, _before(bs, zero, reach, "bigint"), walk))))
    rest = lambda found: text.substr(F.array_max(F.transform(found, lambda s: s["stop"])) + 1, F.length(text))
    return _once(spans, lambda found: F.when(F.size(found) > 0, F.concat(_once(cuts(found), put), rest(found))).otherwise(text))


def pii_fit(docs: DataFrame, text: str = "text", known: Gazetteer = KNOWN) -> SpanModel:
    """Estimate reliabilities and train the classifier from the votes on all candidates of all documents."""
    return fit_cells(count_cells(examined(docs.select(F.col(text).alias("_t")), "_t", known).select("cands")))


def pii_spans(docs: DataFrame, model: SpanModel, text: str = "text", known: Gazetteer = KNOWN) -> DataFrame:
    """docs with base and added: arrays of struct<kind, start, stop>.

    All columns of docs pass through untouched and in place; one that is itself named base or added is called base_input
    or added_input in the result, with more `_input` behind it where that is a column too. Repeated rows stay as they are.
    """
    names = [f"_c{i}" for i in range(len(docs.columns))]
    taken = {*docs.columns, "base", "added"}

    def name(c: str) -> str:
        if c not in ("base", "added"):
            return c
        while c in taken:
            c += "_input"
        return c

    found = examined(docs.toDF(*names), names[docs.columns.index(text)], known)
    return found.select(*[F.col(n).alias(name(c)) for c, n in zip(docs.columns, names)], "base", accepted(model, F.col("base"), F.col("cands")).alias("added"))


def redacted_documents(docs: DataFrame, text: str = "text", n_chars: str = "n_chars", known: Gazetteer = KNOWN) -> DataFrame:
    """docs with every span of the text replaced by its kind and the character count renewed; null texts stay null.

    Patterns run once: rows with their spans and votes go to the checkpoint folder, and both the fit and the redaction
    read them there. Repeated rows and extra columns of any name pass through.
    """
    names = [f"_c{i}" for i in range(len(docs.columns))]
    narrow = docs.toDF(*names).withColumn("_t", F.col(names[docs.columns.index(text)]).cast("string"))
    seen = checkpoint(examined(narrow, "_t", known).drop("_t"))
    model = fit_cells(count_cells(seen))
    own = F.col(names[docs.columns.index(text)])
    clean = seen.withColumn("_clean", redact(own, F.concat("base", accepted(model, F.col("base"), F.col("cands")))))
    out = lambda c, n: F.col("_clean") if c == text else F.length("_clean").cast("bigint") if c == n_chars else F.col(n)
    return clean.select(*[out(c, n).alias(c) for c, n in zip(docs.columns, names)])
