"""Surrogates for personal data and credentials (operator 1, native).

Found entities - e-mail addresses, telephone, payment card and social security numbers, IPv4 addresses,
credentials, names after a title (in any case) or after a known given name, and what is mentioned of them later - get keyed replacements of the same type, format, script and,
for names, gender:

* Strings of letters and digits go through a keyed Feistel permutation of their
  characters: every character stays in its class, so a surrogate has the format of its
  original and different originals have different surrogates. Card numbers keep their first digit and a valid
  check digit, addresses their class, credentials their known prefix.
* Names are drawn by keyed hash from lists by gender and script (given names), or put
  together from syllables (surnames), with more parts on each further attempt.

Every distinct entity of the corpus is in one table. Attempts are checked there:
a surrogate that another entity has, or that is itself an entity of the corpus, is
drawn again, until all differ. So equal entities (however written: case, blanks,
brackets; of credentials, hex digits in capitals or not) have equal surrogates in all documents, and different ones different.

Texts are cut at the matches and put together again by JVM expressions alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import join_hot, packed, saved

#: Key of the surrogates where neither the argument nor the session setting names one: for tests and samples
#: only, since whoever knows the key can undo the permutations.
KEY = "surrogates-1"
KEY_SETTING = "cardwatch.pii.key"
MAX_ATTEMPTS = 12

# Titles and given names by gender, and name parts by script.
TITLES = {"m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "господин"], "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "госпожа"]}
GIVEN = {
    ("m", "latin"): ["Albert", "Christopher", "Daniel", "Edward", "Frederick", "Gregory", "Harold", "Jonathan", "Kenneth", "Leonard", "Matthew", "Nicholas", "Patrick", "Richard", "Stephen", "Theodore", "Vincent", "William"],
    ("f", "latin"): ["Alexandra", "Beatrice", "Catherine", "Dorothy", "Elizabeth", "Florence", "Gabrielle", "Henrietta", "Jacqueline", "Katherine", "Louise", "Margaret", "Natalie", "Penelope", "Rebecca", "Susanna", "Victoria", "Winifred"],
    ("m", "cyrillic"): ["Александр", "Борис", "Виктор", "Григорий", "Дмитрий", "Николай", "Павел", "Сергей"],
    ("f", "cyrillic"): ["Анастасия", "Валентина", "Екатерина", "Людмила", "Надежда", "Ольга", "Светлана", "Татьяна"],
}
# Titles without a gender, and further given names that are found (surrogates are drawn from GIVEN alone).
OTHER_TITLES = ["Dr", "Prof", "Doctor", "Professor", "Doktor", "Docteur", "Professeur", "доктор", "профессор"]
FOUND = {"m": ["Alan", "Alexander", "Andrew", "Anthony", "Antonio", "Benjamin", "Brian", "Carlos", "Charles", "David", "Donald", "Eric", "Francisco", "Frank", "George", "Hans",
               "Henry", "Jack", "Jacques", "James", "Jason", "Javier", "Jean", "Jeffrey", "John", "Joseph", "Juan", "Kevin", "Klaus", "Luis", "Manuel", "Mark", "Martin", "Michael",
               "Miguel", "Paul", "Pedro", "Peter", "Philip", "Pierre", "Robert", "Ronald", "Samuel", "Scott", "Steven", "Thomas", "Timothy", "Wolfgang", "Иван", "Михаил"],
         "f": ["Alice", "Amy", "Ana", "Angela", "Anna", "Barbara", "Brigitte", "Carmen", "Caroline", "Claire", "Deborah", "Emily", "Emma", "Helen", "Ingrid", "Isabel", "Jane",
               "Janet", "Jennifer", "Jessica", "Julia", "Karen", "Laura", "Linda", "Lisa", "Lucía", "Maria", "Marie", "Mary", "Michelle", "Monika", "Nancy", "Pamela", "Patricia",
               "Petra", "Rachel", "Ruth", "Sandra", "Sarah", "Sharon", "Sophie", "Susan", "Ursula", "Мария", "Елена"]}
SYLLABLES = {"latin": ["bar", "del", "fen", "gor", "hal", "kem", "lin", "mar", "nor", "pel", "ros", "sten", "tal", "ver", "wick"],
             "cyrillic": ["бар", "дел", "гор", "кам", "лин", "мар", "нов", "пет", "рос", "сав", "тар"]}

_titles = [t for g in [*TITLES.values(), OTHER_TITLES] for t in g]
_given = [n for g in [*GIVEN.values(), *FOUND.values()] for n in g]
_women = [n for (g, _), names in GIVEN.items() if g == "f" for n in names] + FOUND["f"]
_TITLE = "(?iu:" + "|".join(sorted(_titles, key=len, reverse=True)) + r")\.?"
_KNOWN = "(?:" + "|".join(sorted(_given, key=len, reverse=True)) + r")(?!\p{L})"
_FIRST = "".join(sorted({c for t in _titles for c in (t[0].lower(), t[0].upper())} | {n[0] for n in _given}))
_WORD = r"\p{Lu}\p{L}{1,30}+(?:-\p{Lu}\p{L}{1,30}+){0,2}+"
_SECRET_WORDS = ["password", "passwd", "secret", "token", "api_key", "apikey"]
_SECRET_HEAD = "(?i:" + "|".join(_SECRET_WORDS) + r""")\s{0,2}[=:]\s{0,2}["']?"""
_HEX_UPPER = "^(?=[0-9]*[A-F])[0-9A-F]+$"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"

# Kinds in order: where two could begin at one place, the first is taken.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z])",
    "secret": rf"(?<![A-Za-z]){_SECRET_HEAD}[^\s\"',;]{{6,}}+|(?<![A-Za-z0-9])AKIA[0-9A-Z]{{16}}(?![A-Za-z0-9])",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\d+])\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)|(?<![\d+])\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{2,4}){2,4}(?!\d)"
             r"|(?<![\d(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])(?<!\d )(?:1[ .-])?\d{3}(?:-\d{3}-|\.\d{3}\.|[.-]\d{3}[.-]| \d{3} )\d{4}(?![\d-])(?! \d)",
    "card": r"(?<!\d)(?:\d{13,19}|\d{4}(?:-\d{4}){3}|\d{4}(?: \d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)",
    "person": rf"(?=[{_FIRST}])(?<!\p{{L}})(?:{_TITLE} {_WORD}(?: {_WORD}){{0,2}}|{_KNOWN} {_WORD})",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _number(*parts) -> Column:
    """A keyed 40-bit number of the parts."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 10), 16, 10).cast("long")


def _shifted(half: Column, other: Column, label: Column, key: Column, alphabets: list[str]) -> Column:
    """Every character of ``half`` moved within its alphabet, by a keyed number of its place and of ``other``."""
    def move(c: Column, i: Column) -> Column:
        out = c
        for a in alphabets:
            place = F.instr(F.lit(a), c) - 1
            to = F.pmod(place + _number(key, label, i.cast("string"), other), F.lit(len(a)))
            out = F.when((F.length(c) > 0) & (place >= 0), F.substring(F.lit(a), to.cast("int") + 1, F.lit(1))).otherwise(out)
        return out
    return F.array_join(F.transform(F.filter(F.split(half, ""), lambda c: F.length(c) > 0), move), "")


DIGITS, LOWER, UPPER, HEX = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789abcdef"


def permuted(s: Column, key: Column, alphabets: list[str]) -> Column:
    """A keyed permutation of the strings of one format: four Feistel rounds on the two halves."""
    def rounds(s: Column) -> Column:
        cut = F.floor(F.length(s) / 2).cast("int")
        state = F.struct(F.substring(s, F.lit(1), cut).alias("a"), F.substring(s, cut + 1, F.length(s)).alias("b"))
        step = lambda st, r: F.struct(F.when(r % 2 == 0, st["a"]).otherwise(_shifted(st["a"], st["b"], r.cast("string"), key, alphabets)).alias("a"),
                                      F.when(r % 2 == 0, _shifted(st["b"], st["a"], r.cast("string"), key, alphabets)).otherwise(st["b"]).alias("b"))
        return F.aggregate(F.array(*[F.lit(i) for i in range(4)]), state, step, lambda st: F.concat(st["a"], st["b"]))
    return _let(s, rounds)


def luhn(digits: Column) -> Column:
    """Luhn sum mod 10 of a digit string: 0 if its last digit checks."""
    def add(acc: Column, c: Column) -> Column:
        v = c.cast("int") * F.when(acc["odd"], 2).otherwise(1)
        return F.struct((acc["sum"] + F.when(v > 9, v - 9).otherwise(v)).alias("sum"), (~acc["odd"]).alias("odd"))
    return F.aggregate(F.filter(F.split(F.reverse(digits), ""), lambda c: F.length(c) > 0),
                       F.struct(F.lit(0).alias("sum"), F.lit(False).alias("odd")), add, lambda acc: acc["sum"] % 10)


def _card(digits: Column, key: Column) -> Column:
    body = permuted(F.substring(digits, F.lit(2), F.length(digits) - 2), key, [DIGITS])
    return _let(F.concat(F.substring(digits, 1, 1), body), lambda b: F.concat(b, F.pmod(F.lit(10) - luhn(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")))


def _phone(digits: Column, key: Column) -> Column:
    """Keeps the first digit (three of longer numbers), and the exchange 555 that belongs to nobody."""
    p = lambda s: permuted(s, key, [DIGITS])
    nobody = _let(p(F.concat(F.substring(digits, 2, 2), F.substring(digits, 7, 4))),
                  lambda b: F.concat(F.substring(digits, 1, 1), F.substring(b, 1, 2), F.lit("555"), F.substring(b, 3, 4)))
    return (F.when((F.length(digits) == 10) & (F.substring(digits, 4, 3) == "555"), nobody)
            .when(F.length(digits) == 10, F.concat(F.substring(digits, 1, 1), p(F.substring(digits, 2, 9))))
            .otherwise(F.concat(F.substring(digits, 1, 3), p(F.substring(digits, F.lit(4), F.length(digits))))))


# First octets of addresses that are not set aside for private, local or test use.
PUBLIC = [o for o in range(1, 224) if o not in (10, 100, 127, 169, 172, 192, 198, 203)]


def _ip(address: Column, key: Column) -> Column:
    """Public addresses among public ones; special ones keep their first two octets."""
    def go(o: Column) -> Column:
        num = lambda i: F.element_at(o, i).cast("long")
        size = len(PUBLIC) * 256
        first = F.array_position(F.array(*[F.lit(x).cast("long") for x in PUBLIC]), num(1)) - 1
        x, y = first * 256 + num(2), num(3) * 256 + num(4)

        def step(st, r):
            nx = F.when(r % 2 == 0, st["x"]).otherwise(F.pmod(st["x"] + _number(key, F.lit("x"), r.cast("string"), st["y"].cast("string")), F.lit(size)))
            ny = F.when(r % 2 == 0, F.pmod(st["y"] + _number(key, F.lit("y"), r.cast("string"), st["x"].cast("string")), F.lit(65536))).otherwise(st["y"])
            return F.struct(nx.alias("x"), ny.alias("y"))

        public = F.aggregate(F.array(*[F.lit(i) for i in range(4)]), F.struct(x.alias("x"), y.alias("y")), step, lambda st: F.concat_ws(
            ".", F.element_at(F.array(*[F.lit(p) for p in PUBLIC]), (F.floor(st["x"] / 256) + 1).cast("int")).cast("string"),
            (st["x"] % 256).cast("string"), F.floor(st["y"] / 256).cast("string"), (st["y"] % 256).cast("string")))
        head = F.concat_ws(".", F.element_at(o, 1), F.element_at(o, 2))
        c = F.pmod(num(3) + _number(key, F.lit("c"), head, num(4).cast("string")), F.lit(256))
        special = _let(c, lambda c: F.concat_ws(".", head, c.cast("string"), F.pmod(num(4) + _number(key, F.lit("d"), head, c.cast("string")), F.lit(256)).cast("string")))
        return F.when(first >= 0, public).otherwise(special)
    return _let(F.split(address, r"\."), go)


def _email(address: Column, key: Column) -> Column:
    """The local part and every label of the domain but the last, and but 'example'."""
    p = lambda s: permuted(s, key, [DIGITS, LOWER])
    labels = F.split(F.substring_index(address, "@", -1), r"\.")
    domain = F.transform(labels, lambda x, i: F.when((i == F.size(labels) - 1) | (x == "example"), x).otherwise(p(x)))
    return F.concat(p(F.substring_index(address, "@", 1)), F.lit("@"), F.array_join(domain, "."))


def _secret(value: Column, key: Column) -> Column:
    # a draw that reads as hex in capitals has another normal form: the value itself is an entity, so it is drawn again
    other = _let(permuted(value, key, [DIGITS, LOWER, UPPER]), lambda v: F.when(v.rlike(_HEX_UPPER), value).otherwise(v))
    whole = F.when(value.rlike("^[0-9a-f]+$"), permuted(value, key, [HEX])).otherwise(other)
    return F.when(value.startswith("AKIA"), F.concat(F.lit("AKIA"), permuted(F.substring(value, F.lit(5), F.length(value)), key, [DIGITS, UPPER]))).otherwise(whole)


def _script(name: Column) -> Column:
    return F.when(name.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")


def _drawn(parts: list[str], name: Column, key: Column, n: Column, glue: str) -> Column:
    listed = F.array(*[F.lit(p) for p in parts])
    return F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: F.element_at(
        listed, (F.pmod(_number(key, i.cast("string"), name), F.lit(len(parts))) + 1).cast("int"))), glue)


def _name(kind: Column, name: Column, key: Column, attempt: int) -> Column:
    """A given name of the gender and script, or a surname of syllables; more parts on later attempts."""
    out = F.lit(None).cast("string")
    for (gender, script), listed in GIVEN.items():
        given = _drawn(listed, name, key, F.lit(1 + (attempt + 1) // 2), "-")
        out = F.when((kind == f"given-{gender}") & (_script(name) == script), given).otherwise(out)
    for script, syllables in SYLLABLES.items():
        surname = F.initcap(_drawn(syllables, name, key, F.lit(3 + attempt // 2), ""))
        out = F.when((kind == "surname") & (_script(name) == script), surname).otherwise(out)
    return F.lower(out)


def surrogate(kind: Column, norm: Column, attempt: int = 0, secret: str = KEY) -> Column:
    """The surrogate of an entity in normal form, in normal form."""
    key = F.concat(F.lit(f"{secret}|{attempt}|"), kind)
    return (F.when(kind == "email", _email(norm, key)).when(kind == "card", _card(norm, key)).when(kind == "phone", _phone(norm, key))
            .when(kind == "ip", _ip(norm, key)).when(kind == "ssn", permuted(norm, key, [DIGITS])).when(kind == "secret", _secret(norm, key))
            .otherwise(_name(kind, norm, key, attempt)))


def _digits(raw: Column) -> Column:
    return F.regexp_replace(raw, r"\D", "")


def _may_match(text: Column) -> Column:
    """False only for texts in which no pattern can match: quick tests spare them the long expression."""
    words = [text.contains(w) for w in ["@", "AKIA"]] + [F.lower(text).contains(w) for w in _SECRET_WORDS]
    found = text.rlike("[0-9]")
    for w in words:
        found = found | w
    return found | text.rlike(PATTERNS["person"])


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, t_hash, place, part, kind, norm, raw): a row for each part of each match in ``text``.

    A match has one part, a name one for each given name and one for the surname (parts with a hyphen are one);
    what no part covers (a title, a credential's label) stays.
    """
    hits = docs.filter(_may_match(F.col("text"))).select("doc_id", "t_hash", F.posexplode(F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))).alias("place", "hit"))
    hit = F.col("hit")
    whole = lambda k: F.regexp_like(hit, F.lit(f"^(?:{PATTERNS[k]})$"))
    # lookbehinds see the beginning of the match, which any of them accepts
    kind = F.lit(None).cast("string")
    for k in reversed(PATTERNS):
        kind = F.when(whole(k), F.lit(k)).otherwise(kind)
    hits = hits.withColumn("kind", kind)
    kind = F.col("kind")
    part = lambda k, n, raw: F.struct(k.alias("kind") if isinstance(k, Column) else F.lit(k).alias("kind"), n.alias("norm"), raw.alias("raw"))
    phone = F.when(F.length(_digits(hit)).eqNullSafe(11) & _digits(hit).startswith("1"), F.substring(_digits(hit), 2, 10)).otherwise(_digits(hit))
    secret = F.regexp_replace(hit, f"^{_SECRET_HEAD}", "")
    secret_norm = F.when(secret.rlike(_HEX_UPPER), F.lower(secret)).otherwise(secret)
    bare = F.regexp_replace(hit, f"^{_TITLE} ", "")
    names = F.split(bare, " ")
    # a woman's title, or a woman's name (with any title, or none); a name without either takes a man's form
    woman = F.regexp_like(hit, F.lit("^(?iu:" + "|".join(TITLES["f"]) + r")(?:\.| )")) | F.regexp_like(bare, F.lit("^(?:" + "|".join(_women) + ") "))
    gender = F.when(woman & ~F.regexp_like(hit, F.lit("^(?iu:" + "|".join(TITLES["m"]) + r")(?:\.| )")), "f").otherwise("m")
    person = F.transform(names, lambda n, i: part(F.when(i == F.size(names) - 1, "surname").otherwise(F.concat(F.lit("given-"), gender)), F.lower(n), n))
    one = (F.when(kind == "email", part("email", F.lower(hit), hit)).when(kind == "phone", part("phone", phone, hit))
           .when((kind == "card") & (luhn(_digits(hit)) == 0), part("card", _digits(hit), hit))
           .when(kind == "ssn", part("ssn", _digits(hit), hit)).when(kind == "ip", part("ip", hit, hit)).when(kind == "secret", part("secret", secret_norm, secret)))
    parts = F.when(kind == "person", person).otherwise(F.filter(F.array(one), lambda x: x.isNotNull()))
    return (hits.select("doc_id", "t_hash", "place", "hit", F.posexplode(parts).alias("part", "p"))
            .select("doc_id", "t_hash", "place", "part", "hit", "p.kind", "p.norm", "p.raw"))


def assign(entities: DataFrame, secret: str = KEY) -> DataFrame:
    """(kind, norm) plus a surrogate each: all different, and none an entity of the table.

    Rounds: everyone open draws; of those with one surrogate the first in hash order keeps
    it, unless it is taken or is an entity itself; the others draw again.
    """
    open_, done = entities.select("kind", "norm"), None
    known = entities.select("kind", F.col("norm").alias("drawn"))
    for attempt in range(MAX_ATTEMPTS):
        drawn = saved(open_.withColumn("drawn", surrogate(F.col("kind"), F.col("norm"), attempt, secret)), "pii-drawn")
        taken = known if done is None else known.unionByName(done.select("kind", F.col("surrogate").alias("drawn")))
        free = drawn.join(taken, ["kind", "drawn"], "left_anti")
        first = free.groupBy("kind", "drawn").agg(F.min(F.struct(F.sha2(F.concat_ws("|", F.lit(secret), "norm"), 256).alias("h"), F.col("norm"))).alias("w"))
        won = first.select("kind", F.col("w.norm").alias("norm"), F.col("drawn").alias("surrogate"))
        done = saved(won if done is None else done.unionByName(won), "pii-surrogates")
        open_ = saved(entities.select("kind", "norm").join(done, ["kind", "norm"], "left_anti"), "pii-open")
        if open_.limit(1).count() == 0:
            return done
    # names of this many collisions are numbered; formats never get here unless all their strings are taken
    rest = open_.withColumn("surrogate", F.concat(surrogate(F.col("kind"), F.col("norm"), MAX_ATTEMPTS, secret), F.lit("-"), F.sha2(F.concat_ws("|", F.lit(secret), "kind", "norm"), 256)))
    return saved(done.unionByName(rest), "pii-surrogates")


def _rendered(kind: Column, raw: Column, sub: Column) -> Column:
    """A surrogate written as its original was."""
    def digits(raw: Column, new: Column) -> Column:
        extra = F.length(_digits(raw)) - F.length(new)
        filled = F.concat(F.substring(_digits(raw), F.lit(1), extra), new)
        step = lambda acc, c: F.when(c.rlike(r"^\d$"), F.struct((acc["k"] + 1).alias("k"), F.concat(acc["out"], F.substring(filled, acc["k"] + 1, F.lit(1))).alias("out"))).otherwise(
            F.struct(acc["k"].alias("k"), F.concat(acc["out"], c).alias("out")))
        return F.aggregate(F.filter(F.split(raw, ""), lambda c: F.length(c) > 0), F.struct(F.lit(0).alias("k"), F.lit("").alias("out")), step, lambda acc: acc["out"])

    chars = lambda s: F.filter(F.split(s, ""), lambda c: F.length(c) > 0)
    cased = F.array_join(F.zip_with(chars(raw), chars(sub), lambda a, b: F.when(a != F.lower(a), F.upper(b)).otherwise(b)), "")
    name = F.when((raw == F.upper(raw)) & (F.length(raw) > 1), F.upper(sub)).otherwise(F.array_join(F.transform(F.split(sub, "-"), F.initcap), "-"))
    return (F.when(kind.isin("phone", "card", "ssn"), digits(raw, sub)).when(kind == "email", cased)
            .when((kind == "secret") & raw.rlike(_HEX_UPPER), F.upper(sub)).when(kind.isin("ip", "secret"), sub).otherwise(name))


def key_of(spark) -> str:
    """The key of the session (``cardwatch.pii.key``), else the one for samples."""
    return spark.conf.get(KEY_SETTING, KEY)


def _bare_mentions(between: Column, names: Column) -> Column:
    """Words that are parts of names found in the document, wherever else they stand alone, with the same surrogates."""
    edges = r"(?<=\p{L})(?!\p{L})|(?<!\p{L})(?=\p{L})"
    return F.transform(between, lambda b: F.array_join(F.transform(F.split(b, edges, -1), lambda w: F.coalesce(F.element_at(names, w), w)), ""))


def replace(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", secret: str | None = None) -> DataFrame:
    """``docs`` with surrogates in ``text_col``, and two more columns: n_entities, entity_kinds (sorted, comma-joined).

    All other columns stay as they are (of those two names, ours replace theirs). Null text: null, no entities. Repeated rows get the same text. Null
    ids are documents like others. Entities are the same over the whole table, whatever document they are in. A part of a name that was
    found (three letters or more) is replaced in the rest of its document too, where it stands alone, written the same way or in capitals;
    such mentions are not counted. ``secret``: the key; without it the session's ``cardwatch.pii.key``.
    """
    secret = secret or key_of(docs.sparkSession)
    inner, own_text = packed(docs, id_col, text_col), F.col(f"row.`{text_col}`").alias("text")
    small = inner.select("doc_id", "t_hash", own_text)
    found = saved(find(small).withColumn("entity", F.concat_ws(":", "kind", "norm")), "pii-found")
    entities = saved(found.groupBy("kind", "norm").agg(F.count(F.lit(1)).alias("n")), "pii-entities")
    subs = assign(entities, secret).join(entities, ["kind", "norm"]).select(F.concat_ws(":", "kind", "norm").alias("entity"), "surrogate", "n")
    met = join_hot(found, saved(subs, "pii-subs"), "entity", "n")
    met = met.withColumn("new", _rendered(F.col("kind"), F.col("raw"), F.col("surrogate")))
    met = saved(met, "pii-met")
    # of each document with names: every part as it is written, and its surrogate (one, if a word is both given name and surname)
    alone = (met.filter((F.col("kind") == "surname") | F.col("kind").startswith("given-")).filter(F.length("raw") > 2)
             .select("doc_id", "t_hash", F.inline(F.array(F.struct("raw", "new"), F.struct(F.upper("raw").alias("raw"), F.upper("new").alias("new")))))
             .groupBy("doc_id", "t_hash", "raw").agg(F.max("new").alias("new"))
             .groupBy(F.col("doc_id").alias("n_of"), F.col("t_hash").alias("n_hash")).agg(F.map_from_entries(F.collect_list(F.struct("raw", "new"))).alias("names")))
    # parts of a match, in order, replaced one after the other from the left
    hits = met.groupBy("doc_id", "t_hash", "place").agg(F.first("hit").alias("hit"), F.array_sort(F.collect_set(F.struct("part", "raw", "new", "kind"))).alias("parts"))
    ahead = lambda acc, p: F.instr(acc["rest"], p["raw"]) - 1
    step = lambda acc, p: F.struct(
        F.concat(acc["out"], F.substring(acc["rest"], F.lit(1), ahead(acc, p)), p["new"]).alias("out"),
        F.substring(acc["rest"], ahead(acc, p) + F.length(p["raw"]) + 1, F.length(acc["rest"])).alias("rest"))
    new = F.aggregate("parts", F.struct(F.lit("").alias("out"), F.col("hit").alias("rest")), step, lambda acc: F.concat(acc["out"], acc["rest"]))
    kind = F.element_at("parts", -1)["kind"]
    hits = hits.select("doc_id", "t_hash", F.struct("place", new.alias("new"), F.when(kind == "surname", "person").otherwise(kind).alias("kind")).alias("h"))
    by_doc = hits.groupBy("doc_id", "t_hash").agg(F.array_sort(F.collect_list("h")).alias("hits"))
    by_doc = saved(by_doc.join(alone, F.col("doc_id").eqNullSafe(F.col("n_of")) & F.col("t_hash").eqNullSafe(F.col("n_hash")), "left"), "pii-documents")
    by_doc = by_doc.select(F.col("doc_id").alias("of"), F.col("t_hash").alias("of_hash"), "hits", "names")
    # a shuffle join whatever the size: the matches of all documents are never broadcast
    joined = inner.join(by_doc.hint("merge"), F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("t_hash") == F.col("of_hash")), "left")
    joined = joined.select("row", own_text, "hits", "names")
    # what lies between the matches, and the matches, each of them replaced or as it was
    touched = F.col("hits").isNotNull()
    places = F.map_from_arrays(F.col("hits.place"), F.col("hits.new"))
    joined = joined.withColumns({"between": F.split(F.when(touched, F.col("text")), PATTERN, -1),
                                 "was": F.regexp_extract_all(F.when(touched, F.col("text")), F.lit(PATTERN), F.lit(0)), "now": F.when(touched, places)})
    joined = joined.withColumn("between", F.when(F.col("names").isNull(), F.col("between")).otherwise(_bare_mentions(F.col("between"), F.col("names"))))
    now = F.transform("was", lambda w, i: F.coalesce(F.element_at("now", i), w))
    text = F.when(touched, F.array_join(F.zip_with("between", F.concat(now, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")).otherwise(F.col("text"))
    own = [c for c in docs.columns if c not in ("n_entities", "entity_kinds")]
    return joined.select(*[(text if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in own],
                         F.coalesce(F.size("hits"), F.lit(0)).cast("long").alias("n_entities"),
                         F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.col("hits.kind"))), ","), F.lit("")).alias("entity_kinds"))
