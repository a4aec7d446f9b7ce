"""Personal data replaced by surrogates, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import stored

# What personal data looks like.
# Each begins with a test of one character that most places fail; an address may also begin where a match ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
# A number with +, with an area code in parentheses, or as written within a country: 988-555-2485, 030 1234567.
ABROAD = r"(?=[+(])(?:(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|\+\d{1,3}[ .-]?\(0\)[ .-]?\d(?:[ .-]?\d){6,11}(?!\d)|\+\d{1,3}[ .-]\d{1,3}(?:[ .-]\d{2}){4}(?!\d)|\+\d{1,3}(?:[ .-]\d{2,4}){2,4}(?!\d)|\+\d(?:[ .-]?\d){6,14}(?!\d))"
AT_HOME = r"(?=\d)(?<![\p{L}\d.+/_-])(?:(?:1[ .-])?(?:\d{3}-\d{3}-\d{4}|\d{3}\.\d{3}\.\d{4}|(?<!\d[ ])[2-9]\d{2} [2-9]\d{2}[ -]\d{4}(?! \d))(?![.-]?\d)|(?<!\d[ ])0[1-9](?=(?:[ /.-]?\d){7,10}+(?![ /.-]?\d))\d{0,3}(?:[ /.-]\d{2,8}){1,4})(?!\p{L})"
OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
ADDRESS = rf"(?=\d)(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\d|\.\d)"
# A run of digits in groups, of which one or several in a row may be a card; an address or telephone number ends it.
CARD = rf"(?=\d)(?<![\d.-])\d(?:(?:[ -](?!\d{{1,3}}\.\d|{AT_HOME}))?\d){{12,}}+"
USUAL_CARD = r"^(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{4,5})$"
CLOUD_KEY = r"(?=A)(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])"
SECRET = r"(?<=[=:\"' ])(?=[A-Za-z0-9_+/=-]{8})(?<=[=:][ ]{0,3}[\"']?)(?<=(?i:password|passwd|secret|token|api_key|apikey|api-key)[ ]{0,3}[=:][ ]{0,3}[\"']?)[A-Za-z0-9_+/=-]+"
MEN, WOMEN, ANYONE = ["Mr", "Herr", "Monsieur", "Señor", "г-н", "κ"], ["Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "г-жа", "κα"], ["Dr", "Prof"]
TITLES = sorted(MEN + WOMEN + ANYONE, key=len, reverse=True)
NAME = rf"(?=[{''.join(sorted({t[0] for t in TITLES}))}])(?<!\p{{L}})(?:{'|'.join(TITLES)})\.? \p{{Lu}}\p{{L}}+(?: \p{{Lu}}\p{{L}}+)?"
ANY = "|".join([SECRET, EMAIL, CLOUD_KEY, NAME, ABROAD, ADDRESS, AT_HOME, CARD])

# Syllables of invented names; per script: syllables, then endings for women, men and anyone.
SYLLABLES = {
    "latin": ("ba be bo da de di fa fe ga ka ke ki la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se ta te ti va ve vi", "lia rina", "lor rus", "len"),
    "cyrillic": ("ба бе бо ва ве да де за ка ке ла ле ли ма ме ми на не ни па пе ра ре ро са се та те ти", "лия рина", "лор рус", "лен"),
    "greek": ("βα βε γα δα δε κα κε λα λε λι μα με μι να νε νι πα πε ρα ρε ρο σα σε τα τε τι", "λια ρινα", "λορ ρος", "λεν"),
}
LETTERS = "abcdefghijklmnopqrstuvwxyz"


# Without one of these, beside digits and @, no text has personal data.
WORDS = ["passw", "secret", "token", "api_key", "apikey", "api-key"]
KEY_STARTS = ["AKIA", "ASIA"]


def possible(text: Column) -> Column:
    """A cheap test that every text with a match of ``ANY`` passes."""
    out = text.rlike("[0-9@]")
    for word in WORDS:
        out = out | F.lower(text).contains(word)
    for start in [*TITLES, *KEY_STARTS]:
        out = out | text.contains(start)
    return out


def luhn(digits: Column) -> Column:
    """The sum that a card number's digits must bring to a multiple of 10."""
    at = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(at, F.lit(0), lambda total, x: total + F.coalesce(x, F.lit(0)))


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def kind_of(match: Column) -> Column:
    """What a match of ``ANY`` is; a run of digits is a card when cards were found in it."""
    is_ = lambda pattern: match.rlike(rf"^(?:{pattern})$")
    return (
        F.when(is_(CLOUD_KEY), "cloud_key").when(is_(EMAIL), "email").when(is_(ADDRESS), "address").when(is_(ABROAD) | is_(AT_HOME), "phone").when(is_(NAME), "name")
        .when(is_(CARD), "card").otherwise("secret")
    )


def bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def cards_in(run: Column) -> Column:
    """(start, end) of the cards in a run of digits, from 0, in order: groups in a row of 13 to 19 digits with a right
    check sum.  Of those that overlap the usual forms come first, then the longest, then the first."""
    def among(c: Column) -> Column:
        digit = lambda i: F.coalesce(F.get(c["chars"], i).rlike(r"^\d$"), F.lit(False))
        places = F.sequence(F.lit(0), F.size(c["chars"]) - 1)
        starts, ends = F.filter(places, lambda i: digit(i) & ~digit(i - 1)), F.filter(places, lambda i: digit(i) & ~digit(i + 1))
        return bound(F.struct(c["chars"].alias("chars"), starts.alias("starts"), ends.alias("ends")), chosen)

    def chosen(c: Column) -> Column:
        def ending(start: Column, i: Column) -> Column:
            near = F.filter(F.slice(c["ends"], i + 1, 19), lambda end: (end - start).between(12, 36))
            return F.transform(near, lambda end: F.struct(start.alias("start"), end.alias("end"), F.array_join(F.slice(c["chars"], start + 1, end - start + 1), "").alias("text")))

        fit = lambda x: F.length(digits_of(x["text"])).between(13, 19) & (luhn(digits_of(x["text"])) % 10 == 0)
        found = F.filter(F.flatten(F.transform(c["starts"], ending)), fit)
        ranked = F.sort_array(F.transform(found, lambda x: F.struct((~x["text"].rlike(USUAL_CARD)).alias("odd"), (-F.length(digits_of(x["text"]))).alias("n"), x["start"].alias("start"), x["end"].alias("end"))))
        apart = lambda taken, x: ~F.exists(taken, lambda t: (t["start"] <= x["end"]) & (x["start"] <= t["end"]))
        add = lambda taken, x: F.when(apart(taken, x), F.concat(taken, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"))))).otherwise(taken)
        return F.sort_array(F.aggregate(ranked, F.array().cast("array<struct<start:int,end:int>>"), add))

    return bound(F.struct(F.filter(F.split(run, ""), lambda ch: ch != "").alias("chars")), among)


def pieces_of(match: Column) -> Column:
    """A match of ``ANY`` in pieces (match, kind): all of it, or the cards of a run of digits and what is between them,
    of kind NULL."""
    piece = lambda text, kind: F.struct(text.alias("match"), kind.alias("kind"))
    none = F.lit(None).cast("string")

    def parted(cards: Column) -> Column:
        after = lambda i: F.coalesce(F.get(cards, i - 1)["end"], F.lit(-1)) + 1
        between = lambda x, i: F.array(piece(F.substring(match, after(i) + 1, x["start"] - after(i)), none), piece(F.substring(match, x["start"] + 1, x["end"] - x["start"] + 1), F.lit("card")))
        rest = piece(F.substring(match, after(F.size(cards)) + 1, F.length(match)), none)
        return F.concat(F.flatten(F.transform(cards, between)), F.array(rest))

    return bound(kind_of(match), lambda kind: F.when(kind == "card", bound(cards_in(match), parted)).otherwise(F.array(piece(match, kind))))


def parts_of(match: Column, kind: Column) -> Column:
    """What must stay the same wherever it is met, as an array of (kind, core): digits of numbers, lower-cased
    addresses and names; first names and family names apart, by gender of the title and by script."""
    core = F.when(kind.isin("phone", "card"), digits_of(match)).when(kind == "email", F.lower(match)).otherwise(match)
    title = F.regexp_replace(F.element_at(F.split(match, " "), 1), r"\.$", "")
    gender = F.when(title.isin(MEN), "m").when(title.isin(WOMEN), "f").otherwise("x")
    words = F.slice(F.split(match, " "), 2, 2)
    script = lambda w: F.when(w.rlike(r"\p{IsCyrillic}"), "cyrillic").when(w.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    named = F.transform(words, lambda w, i: F.struct(F.concat(F.when(i < F.size(words) - 1, F.concat(F.lit("given_"), gender)).otherwise("family"), F.lit("_"), script(w)).alias("kind"), F.lower(w).alias("core")))
    return F.when(kind == "name", named).otherwise(F.array(F.struct(kind.alias("kind"), core.alias("core"))))


def drawn(digest: Column, i: Column) -> Column:
    """The i-th number (0 to 65535) of a hex digest, which serves again after 60."""
    return F.conv(F.substring(digest, (i % 60 + 1).cast("int"), F.lit(4)), 16, 10).cast("int")


def shaped(text: Column, digest: Column) -> Column:
    """Digits for digits, letters for letters of the same case, other characters kept."""
    def one(c: Column, i: Column) -> Column:
        n = drawn(digest, i)
        letter = F.substring(F.lit(LETTERS), n % 26 + 1, F.lit(1))
        return F.when(c.rlike("^[0-9]$"), (n % 10).cast("string")).when(c.rlike("^[a-z]$"), letter).when(c.rlike("^[A-Z]$"), F.upper(letter)).otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def invented(kind: Column, digest: Column, attempt: Column) -> Column:
    """A name of two syllables, one more for each further attempt, and the ending of its gender."""
    out = F.lit(None).cast("string")
    for script, (syllables, women, men, anyone) in SYLLABLES.items():
        parts = F.array(*[F.lit(x) for x in syllables.split()])
        body = F.array_join(F.transform(F.sequence(F.lit(0), attempt + 1), lambda i: F.element_at(parts, drawn(digest, i * 5 + 7) % F.size(parts) + 1)), "")
        ends = lambda names: F.element_at(F.array(*[F.lit(x) for x in names.split()]), drawn(digest, F.lit(3)) % len(names.split()) + 1)
        ending = F.when(kind.startswith("given_f"), ends(women)).when(kind.startswith("given_m"), ends(men)).otherwise(ends(anyone))
        out = F.when(kind.endswith(script), F.concat(body, ending)).otherwise(out)
    return out


def surrogate(kind: Column, core: Column, attempt: Column, key: str) -> Column:
    """The replacement of a core: drawn from a keyed digest, of the same kind and format.

    Numbers keep their length, a card number its check sum, a telephone number its first digit, an address stays a
    valid one, an e-mail address keeps its domain's shape and its last label, a cloud key its prefix.
    """
    digest = F.sha2(F.concat_ws("\x00", F.lit(key), kind, core, attempt.cast("string"), F.lit(key)), 256)
    digits = shaped(core, digest)
    payload = F.substring(digits, F.lit(1), F.length(core) - 1)
    check = (10 - luhn(F.concat(payload, F.lit("0"))) % 10) % 10
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (drawn(digest, i * 4) % 254 + 1).cast("string")), ".")
    local, domain = F.substring_index(core, "@", 1), F.substring_index(core, "@", -1)
    host = F.sha2(F.concat_ws("\x00", F.lit(key), F.lit("domain"), domain), 256)
    last = F.substring_index(domain, ".", -1)
    mail = F.concat(shaped(local, digest), F.lit("@"), shaped(F.substring(domain, F.lit(1), F.length(domain) - F.length(last) - 1), host), F.lit("."), last)
    return (
        F.when(kind == "card", F.concat(payload, check.cast("string"))).when(kind == "phone", F.concat(F.substring(core, F.lit(1), F.lit(1)), F.substring(digits, F.lit(2), F.length(core))))
        .when(kind == "address", octets).when(kind == "email", mail)
        .when(kind == "cloud_key", F.concat(F.substring(core, 1, 4), F.substring(shaped(core, digest), F.lit(5), F.length(core))))
        .when((kind == "secret") & core.rlike("^[0-9a-f]+$"), F.rpad(digest, F.length(core), digest))
        .when(kind.startswith("given_") | kind.startswith("family"), invented(kind, digest, attempt)).otherwise(digits)
    )


def assigned(cores: DataFrame, key: str, most: int = 50) -> DataFrame:
    """(kind, core, surrogate) of distinct (kind, core): no two share a surrogate, and none is a core that occurs.

    Surrogates are drawn, counted, and those that clash are drawn anew until none does; the lesser core keeps its draw.
    A format with fewer forms than the corpus has cores of it can't be told apart and is an error after ``most`` turns.
    """
    now = cores.withColumns({"attempt": F.lit(0), "surrogate": surrogate(F.col("kind"), F.col("core"), F.lit(0), key)})
    for _ in range(most):
        now = stored(now)
        first = now.groupBy("surrogate").agg(F.min(F.struct("attempt", "kind", "core")).alias("first"))
        real = cores.select(F.col("core").alias("surrogate")).distinct().withColumn("real", F.lit(True))
        marked = now.join(first, "surrogate").join(real, "surrogate", "left")
        clash = F.col("real").isNotNull() | (F.struct("kind", "core") != F.struct("first.kind", "first.core"))
        if marked.where(clash).isEmpty():
            return now.select("kind", "core", "surrogate")
        again = F.when(clash, F.col("attempt") + 1).otherwise(F.col("attempt"))
        now = marked.select("kind", "core", again.cast("int").alias("attempt"))
        now = now.withColumn("surrogate", surrogate(F.col("kind"), F.col("core"), F.col("attempt"), key))
    raise ValueError("more distinct entities of one format than the format has forms")


def formatted(match: Column, kind: Column, found: Column) -> Column:
    """The surrogates of a match's parts in the format of the match."""
    one = found[0]
    spread = F.transform(F.split(match, ""), lambda c, i: F.when(c.rlike("^[0-9]$"), F.substring(one, F.length(digits_of(F.substring(match, F.lit(1), i + 1))), F.lit(1))).otherwise(c))
    words = F.slice(F.split(match, " "), 2, 2)
    cased = F.zip_with(words, found, lambda w, s: F.when((F.upper(w) == w) & (F.length(w) > 1), F.upper(s)).otherwise(F.initcap(s)))
    return (
        F.when(kind.isin("phone", "card"), F.array_join(spread, "")).when(kind == "email", F.when(match.rlike("[A-Z]") & (F.upper(match) == match), F.upper(one)).otherwise(one))
        .when(kind == "name", F.concat_ws(" ", F.element_at(F.split(match, " "), 1), F.array_join(cased, " "))).otherwise(one)
    )


def replace_personal(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Replace e-mail and network addresses, telephone and card numbers, cloud keys, passwords and tokens, and names
    after a title, in whole texts.

    The same entity has the same surrogate in every document, in whichever format it is written; different entities
    have different ones; none is an entity of the corpus.  Who has ``key`` can draw the same surrogates again, nobody
    else.  Adds n_entities and entities (kinds, sorted); texts without an entity, NULL ones too, stay as they are.
    Rows equal in all columns are replaced alike; columns of the added names are replaced.

    Texts without an entity never move.  Of the others only (row, place, core) rows are exchanged before the texts meet
    their surrogates; rows are told apart by a digest of all their columns.
    """
    own = docs.drop("n_entities", "entities")
    some = F.when(possible(F.col(text)), F.col(text).rlike(ANY)).otherwise(False)
    some = F.coalesce(some, F.lit(False))
    empty = F.array().cast("array<string>")
    clean = own.where(~some).withColumns({"n_entities": F.lit(0).cast("long"), "entities": empty})
    row = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in own.columns]), {"ignoreNullFields": "false"}), 256)
    matches = F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), pieces_of)
    hit = own.where(some).withColumns({"__row": row, "__matches": matches})

    pieces = hit.select("__row", F.posexplode("__matches").alias("at", "pieces")).select("__row", "at", F.posexplode("pieces").alias("piece", "m"))
    places = pieces.where("m.kind is not null").withColumn("place", F.struct("at", "piece"))
    parts = places.select("__row", "place", "m.match", F.col("m.kind").alias("whole"), F.posexplode(parts_of(F.col("m.match"), F.col("m.kind"))).alias("part", "p"))
    parts = stored(parts.select("__row", "place", "match", "whole", "part", "p.kind", "p.core").distinct())
    names = assigned(parts.select("kind", "core").distinct(), key)
    whole = parts.join(names, ["kind", "core"]).groupBy("__row", "place", "match", "whole").agg(F.sort_array(F.collect_list(F.struct("part", "surrogate"))).alias("s"))
    made = whole.select("__row", F.struct("place", formatted(F.col("match"), F.col("whole"), F.col("s.surrogate")).alias("new")).alias("e"))
    made = made.groupBy("__row").agg(F.map_from_entries(F.collect_list("e")).alias("__new"))

    joined = hit.join(made, "__row", "left")
    made_of = lambda i, j: F.element_at(F.col("__new"), F.struct(i.alias("at"), j.alias("piece")))
    new = F.transform("__matches", lambda pieces, i: F.array_join(F.transform(pieces, lambda m, j: F.coalesce(made_of(i, j), m["match"])), ""))
    between = F.flatten(F.zip_with(F.split(text, ANY, -1), F.concat(new, F.array(F.lit(""))), lambda a, b: F.array(a, b)))
    kinds = F.array_sort(F.filter(F.transform(F.flatten("__matches"), lambda m: m["kind"]), lambda k: k.isNotNull()))
    replaced = joined.withColumns({text: F.array_join(between, ""), "n_entities": F.size(kinds).cast("long"), "entities": kinds})
    return clean.unionByName(replaced.select(*clean.columns))
