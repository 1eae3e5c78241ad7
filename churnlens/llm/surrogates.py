r"""Operator 3: personal data replaced by keyed surrogates.

Entities are found by patterns: e-mail addresses, IPv4 addresses, phone
numbers, card numbers, social security numbers, IBANs, access keys and
passwords, and names after forms of address (most of which tell the gender):
all capitalised words that follow, with particles and initials among them. The
last word is the surname, the others are given names; particles stay, initials
become other initials.
Each distinct entity of the corpus gets one surrogate, made from a keyed
hash: same type, length, script, letter case and punctuation; cards keep
their first digit and a valid check digit, names their gender's ending.

So mentions of one entity agree in all documents. Collisions are checked
over the whole corpus: no two entities of a kind share a surrogate, and no
surrogate is an entity that occurs; a candidate that fails is made anew, from
some attempt on longer (``assign`` says where that ends).
DataFrame operations and SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, let

#: Forms of address.
WOMEN = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "Госпожа", "госпожа", "г-жа", "κυρία", "κα")
MEN = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Don", "Господин", "господин", "г-н", "κύριος", "κ")
#: Titles of anyone, and small words inside names.
TITLES = ("Dr", "Prof", "Professor", "Doktor", "Docteur", "Doctor", "Доктор", "доктор", "Δρ")
PARTICLES = ("van", "von", "vom", "der", "den", "de", "del", "della", "di", "da", "dos", "das", "du", "des", "la", "le", "zu", "zum",
             "zur", "ten", "ter", "af", "av", "bin", "ibn", "al", "el", "y")
#: Letters by script, vowels then consonants.
LETTERS = {
    "latin": ("aeiou", "bcdfghjklmnprstvz"),
    "cyrillic": ("аеиоу", "бвгджзклмнпрстфхч"),
    "greek": ("αειου", "βγδζθκλμνπρστφχ"),
}
#: Last letters of given names by script: women, men.
ENDINGS = {"latin": ("a", "n"), "cyrillic": ("а", "н"), "greek": ("α", "ς")}

_any = lambda words: "|".join(sorted(words, key=len, reverse=True))
_TITLE = _any(WOMEN + MEN + TITLES)
_ADDRESS = rf"(?:(?:{_TITLE})\.? )++"
_INITIAL = r"(?:\p{Lu}\.)++"
_NAME = r"\p{Lu}[\p{L}\p{M}]++(?:['’-]\p{Lu}[\p{L}\p{M}]++)*+"
_PART = rf"(?:(?:{_any(PARTICLES)}) )*+{_NAME}"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}_%+-]++(?:\.[\p{L}\p{N}_%+-]++)*+@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++",
    "ip": r"(?<![\p{L}\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\p{L}\p{N}]|\.\d)",
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}]|-\d)",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}"
             r"|\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\p{L}\p{N}])",
    "card": r"(?<![\p{L}\p{N}])[3-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\p{L}\p{N}])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "access": r"(?<![\p{L}\p{N}])(?:AKIA|ASIA)[0-9A-Z]{16}(?![\p{L}\p{N}])",
    "secret": r"(?<![\p{L}\p{N}])(?i:password|passwd|pwd|secret|token|api[_-]?key) ?[=:] ?[\"']?[\p{L}\p{N}+/_-]{8,}+",
    "person": rf"(?<![\p{{L}}\p{{N}}]){_ADDRESS}(?:{_INITIAL} )*+{_PART}(?: (?:{_INITIAL}|{_PART}))*+",
}
_ALL = "|".join(PATTERNS.values())
#: What every entity has; cheap to test, and true of few texts.
_GATE = rf"\d|@|(?i:password|passwd|pwd|secret|token|api[_-]?key)|(?<!\p{{L}})(?:{_TITLE})\.? \p{{L}}"
#: From this attempt on a surrogate is longer than its entity, by one character more each time; the last attempt.
LONGER, ATTEMPTS = 6, 60


def _byte(digest: Column, at: Column) -> Column:
    """A number from 0 to 255 for a place in the surrogate."""
    place = F.pmod(at, F.lit(30)) * 2 + 1
    return (F.conv(F.substring(digest, place, F.lit(2)), 16, 10).cast("int")
            + F.call_function("div", at, F.lit(30)).cast("int") * 7)


def _pick(choices: str, number: Column) -> Column:
    return F.substring(F.lit(choices), F.pmod(number, F.lit(len(choices))) + 1, F.lit(1))


def _letter(c: Column, number: Column) -> Column:
    """A letter of the same script and kind (vowel or consonant), small."""
    accented = r"[àáâãäåæèéêëìíîïòóôõöøùúûüýÿœaeiouy]"
    cyrillic, greek = r"\p{IsCyrillic}", r"\p{IsGreek}"
    kinds = F.when(c.rlike("[аеёиоуыэюя]"), _pick(LETTERS["cyrillic"][0], number))
    kinds = kinds.when(c.rlike(cyrillic), _pick(LETTERS["cyrillic"][1], number))
    kinds = kinds.when(c.rlike("[αάεέηήιίϊΐοόυύϋΰωώ]"), _pick(LETTERS["greek"][0], number))
    kinds = kinds.when(c.rlike(greek), _pick(LETTERS["greek"][1], number))
    return kinds.when(c.rlike(accented), _pick(LETTERS["latin"][0], number)).otherwise(_pick(LETTERS["latin"][1], number))


def _shaped(value: Column, digest: Column) -> Column:
    """Digits for digits, letters for letters (see ``_letter``), the rest kept."""
    def one(c: Column, i: Column) -> Column:
        number = _byte(digest, i)
        return F.when(c.rlike("^[0-9]$"), F.pmod(number, F.lit(10)).cast("string")).when(
            c.rlike(r"^\p{Lu}$"), F.upper(_letter(F.lower(c), number))).when(
            c.rlike(r"^\p{L}$"), _letter(c, number)).otherwise(c)
    return F.array_join(F.transform(F.split(value, ""), one), "")


def _hex(value: Column, digest: Column) -> Column:
    """Hexadecimal digits for hexadecimal digits."""
    return F.array_join(F.transform(F.split(value, ""), lambda c, i: _pick("0123456789abcdef", _byte(digest, i))), "")


def _digits(value: Column, digest: Column) -> Column:
    """Digits for digits, the first never 0."""
    def one(c: Column, i: Column) -> Column:
        number = _byte(digest, i)
        return F.when(i == 0, F.pmod(number, F.lit(9)) + 1).otherwise(F.pmod(number, F.lit(10))).cast("string")
    return F.array_join(F.transform(F.split(value, ""), one), "")


def _card(value: Column, digest: Column) -> Column:
    """The first digit kept, a valid check digit last."""
    def checked(body: Column) -> Column:
        def weigh(c: Column, i: Column) -> Column:
            twice = c.cast("int") * 2
            return F.when(F.pmod(F.char_length(body) - i, F.lit(2)) == 1, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(c.cast("int"))
        total = F.aggregate(F.transform(F.split(body, ""), weigh), F.lit(0), lambda a, x: a + x)
        return F.concat(body, F.pmod(-total, F.lit(10)).cast("string"))
    size = F.char_length(value)
    body = F.concat(F.substring(value, F.lit(1), F.lit(1)), F.substring(_digits(value, digest), F.lit(2), size - 2))
    return let(body, checked)


def _ip(value: Column, digest: Column, attempt: Column) -> Column:
    """Octets of as many digits (of any, from a later attempt on; still later with a port)."""
    def one(octet: Column, i: Column) -> Column:
        number = F.conv(F.substring(digest, i * 4 + 1, F.lit(4)), 16, 10).cast("int")
        size = F.when(attempt >= LONGER, 3).otherwise(F.char_length(octet))
        return F.when(size == 1, F.pmod(number, F.lit(9)) + 1).when(
            size == 2, F.pmod(number, F.lit(90)) + 10).otherwise(F.pmod(number, F.lit(155)) + 100).cast("string")
    port = F.when(attempt > LONGER + 4, F.concat(F.lit(":"), F.pmod(F.conv(F.substring(digest, 33, 4), 16, 10).cast("int"), F.lit(60_000)) + 1024))
    return F.concat(F.array_join(F.transform(F.split(value, r"\."), one), "."), F.coalesce(port, F.lit("")))


def _email(value: Column, digest: Column, domain_digest: Column) -> Column:
    """A shaped local part at a domain made from the domain alone, under example.com, .org or .net."""
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    labels = F.split(domain, r"\.")
    sub = _shaped(F.array_join(F.slice(labels, 1, F.greatest(F.size(labels) - 2, F.lit(0))), "."), domain_digest)
    top = F.when(F.element_at(labels, -1).isin("com", "org", "net"), F.element_at(labels, -1)).otherwise("com")
    name = _shaped(F.when(F.size(labels) > 1, F.element_at(labels, -2)).otherwise("x"), domain_digest)
    return F.concat(_shaped(local, digest), F.lit("@"), sub, F.when(sub != "", ".").otherwise(""),
                    name, F.lit(".example."), top)


def _name(value: Column, digest: Column, kind: Column) -> Column:
    """A shaped name; given names end as their gender's do."""
    script = F.when(value.rlike(r"\p{IsCyrillic}"), "cyrillic").when(value.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    ends = F.create_map(*[F.lit(x) for s, pair in ENDINGS.items() for x in (f"{s} given_f", pair[0], f"{s} given_m", pair[1])])
    end = ends[F.concat_ws(" ", script, kind)]
    shaped = _shaped(value, digest)
    return F.when(end.isNull(), shaped).otherwise(
        F.concat(F.substring(shaped, F.lit(1), F.greatest(F.char_length(shaped) - 1, F.lit(1))), end))


def surrogate(kind: Column, value: Column, attempt: Column, key: str) -> Column:
    """The candidate for an entity; another one for each attempt."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), kind, attempt.cast("string"), value), 256)
    domain = F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain"), F.substring_index(value, "@", -1)), 256)

    def made(d: Column) -> Column:
        more = F.greatest(attempt - (LONGER - 1), F.lit(0))
        longer = F.repeat(F.lit("b"), F.when(kind.isin("ip", "card"), 0).otherwise(more))
        plain = (F.when(kind == "email", _email(F.concat(longer, value), d, domain))
                 .when(kind == "ip", _ip(value, d, attempt))
                 .when(kind == "card", _card(F.rpad(value, F.greatest(F.char_length(value), F.least(F.char_length(value) + more, F.lit(19))), "0"), d))
                 .when(kind.isin("phone", "ssn"), _digits(F.concat(F.repeat(F.lit("1"), more), value), d))
                 .when(kind == "iban", F.concat(F.substring(value, 1, 2), F.upper(_shaped(F.concat(F.substring(value, F.lit(3), F.char_length(value)), longer), d))))
                 .when(kind == "access", F.concat(F.substring(value, 1, 4), F.upper(_shaped(F.concat(F.substring(value, F.lit(5), F.char_length(value)), longer), d))))
                 .when((kind == "secret") & value.rlike("^[0-9a-f]+$"), _hex(F.concat(value, F.repeat(F.lit("0"), more)), d))
                 .when(kind == "secret", _shaped(F.concat(value, longer), d))
                 .otherwise(_name(F.concat(value, longer), d, kind)))
        return plain
    return let(digest, made)


NAMES = ("given_f", "given_m", "given_n", "surname")


def _space(kind: Column) -> Column:
    """What entities of several kinds are compared in: names are one space."""
    return F.when(kind.isin(*NAMES), "name").otherwise(kind)


def assign(entities: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """(kind, value, surrogate) of distinct entities (kind, value), checked.

    Among equal candidates the smallest value keeps its one; the others, and
    those whose candidate is an entity or taken already, try again. Texts grow
    with the attempts, so these find free ones; addresses are four octets of
    three digits, then with a port (3e13), cards have up to 19 digits. A kind
    with more entities than that ends in an error after ``ATTEMPTS``, not in
    surrogates that are shared."""
    given = entities.select(_space(F.col("kind")).alias("space"), F.col("value").alias("made")).distinct()
    left, done, attempt = entities, None, 0
    while True:
        made = left.withColumn("made", surrogate(F.col("kind"), F.col("value"), F.lit(attempt), key))
        made = scratch.save(made.withColumn("space", _space(F.col("kind"))), f"made-{attempt}")
        free = made.join(given, ["space", "made"], "left_anti")
        if done is not None:
            free = free.join(done.select("space", "made"), ["space", "made"], "left_anti")
        first = free.groupBy("space", "made").agg(F.min(F.struct("value", "kind")).alias("won"))
        good = first.select("space", "made", "won.value", "won.kind")
        good = scratch.save(good, f"good-{attempt}")
        done = good if done is None else done.unionByName(good)
        left = made.select("kind", "value").join(good, ["kind", "value"], "left_anti")
        left = scratch.save(left, f"left-{attempt}")
        if left.isEmpty():
            return done.select("kind", "value", F.col("made").alias("surrogate"))
        attempt += 1
        if attempt > ATTEMPTS:
            raise ValueError(f"no free surrogates left for kinds {sorted(r.kind for r in left.select('kind').distinct().collect())}")


def _kind(mention: Column) -> Column:
    anchored = lambda kind: mention.rlike("^(?:" + PATTERNS[kind] + ")$")
    address = lambda words: mention.rlike(rf"^(?:(?:{_TITLE})\.? )*(?:{_any(words)})\.? ")
    out = F.when(anchored("email"), "email").when(anchored("ip"), "ip").when(anchored("ssn"), "ssn")
    out = out.when(anchored("phone"), "phone").when(anchored("card"), "card").when(anchored("iban"), "iban")
    out = out.when(anchored("access"), "access").when(anchored("secret"), "secret")
    return out.when(address(WOMEN), "woman").when(address(MEN), "man").otherwise("anyone")


PEOPLE = ("woman", "man", "anyone")


def _words(mention: Column) -> Column:
    """The words of a name without its titles."""
    return F.split(F.regexp_replace(mention, f"^{_ADDRESS}", ""), " ")


def _tokens(kind: Column, mention: Column) -> Column:
    """The entities in a mention: (part, kind, value, shown), value the form in which mentions agree,
    part the place among a name's words."""
    def entity(k, value: Column, shown: Column, part: Column | None = None) -> Column:
        return F.struct((F.lit(0) if part is None else part).alias("part"),
                        (k if isinstance(k, Column) else F.lit(k)).alias("kind"), value.alias("value"), shown.alias("shown"))
    digits = F.regexp_replace(mention, r"\D", "")
    country = F.length(F.regexp_extract(mention, r"^\+(\d{1,3})[ .(-]", 1))
    national = F.substring(digits, country + 1, F.length(digits))
    spoken = F.regexp_extract(mention, r"([\p{L}\p{N}+/_-]+)$", 1)
    given = F.when(kind == "woman", "given_f").when(kind == "man", "given_m").otherwise("given_n")
    places = F.filter(F.transform(_words(mention), lambda w, i: F.struct(i.alias("i"), w.alias("w"))),
                      lambda p: p["w"].rlike(f"^{_NAME}$"))
    person = let(places, lambda names: F.transform(names, lambda p, i: entity(
        F.when(i == F.size(names) - 1, "surname").otherwise(given), F.lower(p["w"]), p["w"], p["i"])))
    return (F.when(kind.isin(*PEOPLE), person)
            .when(kind == "phone", F.array(entity(kind, national, national)))
            .when(kind.isin("card", "ssn"), F.array(entity(kind, digits, mention)))
            .when(kind == "email", F.array(entity(kind, F.lower(mention), mention)))
            .when(kind == "iban", F.array(entity(kind, F.replace(mention, F.lit(" "), F.lit("")), mention)))
            .when(kind == "secret", F.array(entity(kind, spoken, spoken)))
            .otherwise(F.array(entity(kind, mention, mention))))


def _named(mention: Column, parts: Column, key: str) -> Column:
    """A name with its titles and particles, its words and initials replaced."""
    def word(w: Column, i: Column) -> Column:
        new = F.filter(parts, lambda p: p["part"] == i)
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("initial"), F.element_at(parts, -1)["new"], w), 256)
        return F.when(F.size(new) > 0, F.get(new, F.lit(0))["new"]).when(w.rlike(f"^{_INITIAL}$"), _shaped(w, digest)).otherwise(w)
    return F.concat(F.regexp_extract(mention, f"^{_ADDRESS}", 0), F.array_join(F.transform(_words(mention), word), " "))


def _filled(mention: Column, signs: str, made: Column, skip: Column) -> Column:
    """``mention``, its characters of class ``signs`` after the first ``skip`` replaced
    by those of ``made`` in order; what is left of ``made`` goes at the end."""
    def step(state: Column, c: Column) -> Column:
        mine = c.rlike(signs)
        use = mine & (state["n"] >= skip)
        return F.struct(F.concat(state["out"], F.when(use, F.substring(made, state["n"] - skip + 1, F.lit(1))).otherwise(c)).alias("out"),
                        (state["n"] + mine.cast("int")).alias("n"))
    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))
    whole = F.aggregate(F.split(mention, ""), zero, step)
    return let(whole, lambda w: F.concat(w["out"], F.substring(made, w["n"] - skip + 1, F.char_length(made))))


def _cased(shown: Column, made: Column) -> Column:
    """Capitals as in the mention: letter by letter where the lengths agree, else all, the first, or as made."""
    each = F.array_join(F.zip_with(F.split(shown, ""), F.split(made, ""), lambda a, b: F.when(F.lower(a) != a, F.upper(b)).otherwise(b)), "")
    return (F.when(F.char_length(shown) == F.char_length(made), each)
            .when((F.upper(shown) == shown) & (F.char_length(shown) > 1) & (F.lower(shown) != shown), F.upper(made))
            .when(F.substring(shown, 1, 1).rlike(r"\p{Lu}"), F.concat(F.upper(F.substring(made, 1, 1)), F.substring(made, F.lit(2), F.char_length(made))))
            .otherwise(made))


def _render(kind: Column, mention: Column, shown: Column, made: Column) -> Column:
    """A mention's replacement in the mention's own format."""
    country = F.length(F.regexp_extract(mention, r"^\+(\d{1,3})[ .(-]", 1))
    return (F.when(kind == "phone", _filled(mention, "[0-9]", made, country))
            .when(kind.isin("card", "ssn"), _filled(mention, "[0-9]", made, F.lit(0)))
            .when(kind == "iban", _filled(mention, "[A-Z0-9]", made, F.lit(0)))
            .when(kind == "secret", F.concat(F.substring(mention, F.lit(1), F.char_length(mention) - F.char_length(shown)), made))
            .when(kind.isin("email", *NAMES), _cased(shown, made)).otherwise(made))


def replace_entities(spark: SparkSession, docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with surrogates in ``text``, and a column ``n_entities``.

    All rows and columns stay (but for an ``n_entities`` there was before);
    ``n_chars``, if there, is the new length. A
    null text stays null with no entities. Rewriting depends on the text
    alone, so repeated rows agree, and equal texts are worked on once.
    Untitled mentions of a name found in the same text are replaced as well."""
    scratch = Scratch(spark, "surrogates")
    text = F.col("text")
    found = text.rlike(_GATE) & text.rlike(_ALL)
    mentions = (docs.where(found).select(F.sha2("text", 256).alias("_pii_key"), F.regexp_extract_all("text", F.lit(_ALL), F.lit(0)).alias("_pii_mentions"))
                .groupBy("_pii_key").agg(F.first("_pii_mentions").alias("_pii_mentions")).select("_pii_key", F.posexplode("_pii_mentions").alias("pos", "mention")))
    mentions = mentions.withColumn("whole", _kind(F.col("mention")))
    tokens = mentions.select("_pii_key", "pos", "mention", "whole", F.explode(_tokens(F.col("whole"), F.col("mention"))).alias("e"))
    tokens = scratch.save(tokens.select("_pii_key", "pos", "mention", "whole", "e.*"), "tokens")
    made = assign(tokens.select("kind", "value").distinct(), key, scratch)
    tokens = (tokens.join(made, ["kind", "value"])
              .withColumn("new", _render(F.col("kind"), F.col("mention"), F.col("shown"), F.col("surrogate"))))
    spans = tokens.groupBy("_pii_key", "pos").agg(
        F.first("whole").alias("whole"), F.first("mention").alias("mention"),
        F.sort_array(F.collect_list(F.struct("part", "shown", "new"))).alias("parts"))
    named = F.col("whole").isin(*PEOPLE)
    spans = spans.withColumn("new", F.when(named, _named(F.col("mention"), F.col("parts"), key)).otherwise(F.get("parts.new", F.lit(0))))
    names = F.flatten(F.collect_list(F.when(named, F.transform("parts", lambda p: F.struct(p["shown"], p["new"])))))
    rewritten = scratch.save(spans.groupBy("_pii_key").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "new"))), lambda s: s["new"]).alias("_pii_new"),
        F.array_distinct(names).alias("_pii_names")), "rewritten")
    gaps = F.split("text", _ALL)
    joined = F.array_join(F.zip_with(gaps, F.concat("_pii_new", F.array(F.lit(""))), lambda g, n: F.concat(g, n)), "")
    words = F.split(joined, r"(?<=[\p{L}\p{M}])(?![\p{L}\p{M}])|(?<![\p{L}\p{M}])(?=[\p{L}\p{M}])")

    def renamed(word: Column) -> Column:
        match = F.filter("_pii_names", lambda n: n["shown"] == word)
        return F.when(F.size(match) > 0, F.get(match, F.lit(0))["new"]).otherwise(word)

    fresh = F.when(F.size("_pii_names") > 0, F.array_join(F.transform(words, renamed), "")).otherwise(joined)
    rows = docs.where(found).withColumn("_pii_key", F.sha2("text", 256)).join(rewritten, "_pii_key")
    columns = [c for c in docs.columns if c not in ("text", "n_chars", "n_entities")]
    changed = rows.select(*columns, fresh.alias("text"), F.size("_pii_new").alias("n_entities"))
    same = docs.where(~F.coalesce(found, F.lit(False))).select(*columns, "text", F.lit(0).alias("n_entities"))
    out = same.unionByName(changed)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.char_length("text").cast(kind))
    return out.select(*[c for c in docs.columns if c != "n_entities"], "n_entities")


#: For queries and tests; a production run passes its own secret.
QUERY_KEY = "surrogates"


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` with surrogates for personal data."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return replace_entities(spark, docs, QUERY_KEY)
