"""Private data: detection, and keyed surrogates that keep type, format, script and gender.

All DataFrame and SQL functions.  Every distinct entity (a phone number is the same
however it is punctuated, an address whatever its case) gets one surrogate from a keyed
hash (HMAC), so mentions of one entity agree across all documents; a surrogate that equals
another entity's, or a real value, is drawn again until all are distinct.  A draw that
has failed some times may be longer or of wider form, so that no format runs out.  Family
names have surrogates of their own, so that long and short mentions of a person agree; the full name
of a titled person is replaced wherever the text repeats it without the title.
"""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.llm.work import join_hot, stage

#: How entities look; the first that matches at a place wins.
PATTERNS = {
    "email": r"(?<![\w.+-])[\w+-][\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "secret": r"(?i:\b(?:password|passwd|token|secret|api[_-]?key)\b) ?[=:] ?\"?[A-Za-z0-9/+_-]{8,}\"?",
    "ip": r"(?<![\d.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?![\d.]*\d)",
    "card": r"(?<!\d)[3-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{3,4}(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip6": r"(?<![\w:])(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}(?![\w:])|(?<![\w:])(?:[0-9a-fA-F]{1,4}:){1,6}(?::[0-9a-fA-F]{1,4}){1,6}(?![\w:])",
    "phone": r"(?<![\d+])\+?\d{1,3}[ .-]?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<![\d+])\+\d{8,14}(?!\d)"
    r"|(?<![\d+])\+\d{1,3}(?:[ .-]\d{2,4}){1,2}[ .-]?\d{4,8}(?!\d)|(?<![\d+-])(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\d-])",
    "name": None,  # from the parts below
}
#: Words that stand before a person's name, by gender (none: either) and script.
TITLES = {
    ("m", "latin"): "Mr Herr Señor Sr Monsieur Mister Sir Don".split(),
    ("f", "latin"): "Mrs Ms Miss Frau Señora Sra Señorita Madame Mme Mademoiselle Mlle Lady Doña".split(),
    ("", "latin"): "Dr Prof Professor Doktor Docteur Doctor Doctora".split(),
    ("m", "cyrillic"): "г-н господин".split(),
    ("f", "cyrillic"): "г-жа госпожа".split(),
    ("m", "greek"): "κύριος κ Κύριος Κ".split(),
    ("f", "greek"): "κυρία κα Κυρία Κα".split(),
}
#: A name's word: capital and small letters, in parts joined by hyphens, or after a short prefix as in O'Neil.
_WORD = r"(?:\p{Lu}['’])?\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)*"
_TITLE = "|".join(sorted((t for ts in TITLES.values() for t in ts), key=lambda t: (-len(t), t)))
PATTERNS["name"] = rf"(?<![\p{{L}}\d_-])(?:{_TITLE})\.? {_WORD}(?: {_WORD})?"
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A text without any of these holds no entity: each pattern's match holds one of them.
HINT = rf"@|\d\d|:[0-9a-fA-F:]|\d\.\d|[=:] ?\"?[A-Za-z0-9/+_-]{{8}}|(?<![\p{{L}}\d_-])(?:{_TITLE})\.? "

#: Given names by gender and script.
NAMES = {
    ("m", "latin"): "Adam Bruno Carl Daniel Edgar Felix Georg Hugo Ivan Jonas Karl Leon Martin Niklas Oscar Paul".split(),
    ("f", "latin"): "Anna Berta Clara Diana Emma Flora Greta Helena Irene Julia Katrin Laura Maria Nora Olivia Paula".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Леонид Максим Никита Олег Павел Роман Семён Тимур".split(),
    ("m", "greek"): "Άγγελος Βασίλης Γιώργος Δημήτρης Ηλίας Θάνος Ιάσων Κώστας Λάμπρος Μάριος Νίκος Πέτρος Σπύρος Τάσος Φώτης Χρήστος".split(),
    ("f", "greek"): "Άννα Βάσω Γεωργία Δήμητρα Ελένη Ζωή Θάλεια Ιωάννα Κατερίνα Λίνα Μαρία Νίκη Ξένια Ρένα Σοφία Χριστίνα".split(),
    ("f", "cyrillic"): "Алла Вера Галина Дарья Елена Жанна Зоя Инна Ксения Лидия Марина Нина Ольга Полина Раиса Софья".split(),
}
SYLLABLES = {
    "latin": "ba be bo da de do ka ke ko la le lo ma me mo na".split(),
    "cyrillic": "ба бе бо да де до ка ке ко ла ле ло ма ме мо на".split(),
    "greek": "βα βε βο δα δε δο κα κε κο λα λε λο μα με μο να".split(),
}


def hmac_sha256(key: bytes, message: Column) -> Column:
    """Hex digits of the keyed-hash message authentication code, from SQL's SHA-256."""
    block = (sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = bytes(x ^ 0x36 for x in block), bytes(x ^ 0x5C for x in block)
    first = F.unhex(F.sha2(F.concat(F.lit(inner), F.encode(message, "UTF-8")), 256))
    return F.sha2(F.concat(F.lit(outer), first), 256)


def _stream(key: str, seed: Column, length: Column) -> Column:
    """Hex digits of a keyed hash, two for each of ``length`` characters and more."""
    return F.array_join(
        F.transform(
            F.sequence(F.lit(0), F.floor(length / 32).cast("int") + 1), lambda j: hmac_sha256(key.encode(), F.concat_ws("|", seed, j.cast("string")))
        ),
        "",
    )


def _byte(stream: str, i: str) -> str:
    return f"cast(conv(substring({stream}, 2 * ({i}) + 1, 2), 16, 10) AS int)"


def _letters(value: str, stream: str, keep: str = "false") -> str:
    """SQL: digits become digits and letters letters of the same case; hex letters stay hex in ``hex`` values."""
    c, b = f"substring({value}, i + 1, 1)", _byte(stream, "i")
    return f"""array_join(transform(sequence(0, length({value}) - 1), i -> CASE
        WHEN {keep} THEN {c}
        WHEN {c} RLIKE '[0-9]' THEN cast({b} % 10 AS string)
        WHEN {c} RLIKE '[a-z]' THEN char(97 + {b} % IF({value} RLIKE '^[0-9a-f]+$', 6, 26))
        WHEN {c} RLIKE '[A-Z]' THEN char(65 + {b} % IF({value} RLIKE '^[0-9A-F]+$', 6, 26))
        ELSE {c} END), '')"""


def _luhn(digits: str) -> str:
    """SQL: the check digit that follows ``digits``."""
    d = f"cast(substring({digits}, length({digits}) - i, 1) AS int)"
    total = f"aggregate(transform(sequence(0, length({digits}) - 1), i -> IF(i % 2 = 0, (2 * {d}) div 10 + (2 * {d}) % 10, {d})), CAST(0 AS BIGINT), (a, x) -> a + x)"
    return f"cast((10 - {total} % 10) % 10 AS string)"


def kinds_of(surface: Column) -> Column:
    """Type of an entity found by ANY."""
    out = None
    for kind, p in PATTERNS.items():
        test = surface.rlike(f"^(?:{p})$")
        out = F.when(test, F.lit(kind)) if out is None else out.when(test, F.lit(kind))
    return out.otherwise(F.lit("phone"))


def canonical(kind: Column, surface: Column) -> Column:
    """What mentions of one entity have in common; it is also what a surrogate is drawn for."""
    return (
        F.when(kind == "email", F.lower(surface))
        .when(kind.isin("phone", "card", "ssn"), F.regexp_replace(surface, r"\D", ""))
        .when(kind == "iban", F.replace(surface, F.lit(" "), F.lit("")))
        .when(kind == "ip6", F.lower(surface))
        .when(kind == "secret", F.regexp_extract(surface, r"[=:] ?\"?([A-Za-z0-9/+_-]{8,})\"?$", 1))
        .when(kind == "name", F.regexp_replace(surface, r"\.", ""))
        .otherwise(surface)
    )


def draw(df: DataFrame, key: str) -> DataFrame:
    """Add ``surrogate`` for ``kind``, ``canon``, ``family`` and ``attempt``: the keyed draw of that attempt.

    Kind ``family`` is a family name alone; a name takes the surrogate of its family name from ``family``."""
    df = df.withColumn(
        "stream", _stream(key, F.concat_ws("|", "kind", "canon", F.col("attempt").cast("string")), F.length("canon"))
    )
    octets = f"""array_join(transform(split(canon, '[.]'), (o, i) -> cast(CASE least(3, length(o) + attempt div 4)
        WHEN 1 THEN 1 + {_byte('stream', 'i')} % 9 WHEN 2 THEN 10 + {_byte('stream', 'i')} % 90
        ELSE 100 + {_byte('stream', 'i')} % 155 END AS string)), '.')"""
    body = "substring(_d, 1, length(_d) - 1)"
    women, men = ("|".join(t for (g, _), ts in TITLES.items() for t in ts if g == gender) for gender in "fm")
    # a title of either gender leaves it to the hash
    female = f"(canon RLIKE '^({women}) ' OR (NOT canon RLIKE '^({men}) ' AND {_byte('stream', '1')} % 2 = 0))"
    parts = "split(canon, ' ')"

    def pick(values: list[str], at: str) -> str:
        return f"get(array({', '.join(repr(v) for v in values)}), {at} % {len(values)})"

    def syllables(script: str, first: str, n: str) -> str:
        return f"array_join(transform(sequence(1, {n}), i -> {pick(SYLLABLES[script], _byte('stream', f'{first} + i'))}), '')"

    def name(script: str) -> str:
        given = f"IF({female}, {pick(NAMES['f', script], _byte('stream', '0'))}, {pick(NAMES['m', script], _byte('stream', '0'))})"
        given = f"IF(attempt < 4, {given}, concat({given}, {syllables(script, '0', 'greatest(1, attempt div 4)')}))"
        return f"IF(size({parts}) > 2, concat_ws(' ', get({parts}, 0), {given}, family), concat_ws(' ', get({parts}, 0), family))"

    def family(script: str) -> str:
        word = f"initcap({syllables(script, '0', '4 + attempt div 2')})"
        # double names stay double, and a prefix as in O'Neil stays
        second = f"IF(canon LIKE '%-%', concat('-', initcap({syllables(script, '9 + attempt div 2', '3')})), '')"
        prefix = "IF(ascii(substring(canon, 2, 1)) IN (39, 8217), left(canon, 2), '')"  # an apostrophe
        return f"concat({prefix}, {word}, {second})"

    def by_script(f) -> str:
        return f"CASE WHEN canon RLIKE '[\\u0400-\\u04FF]' THEN {f('cyrillic')} WHEN canon RLIKE '[\\u0370-\\u03FF]' THEN {f('greek')} ELSE {f('latin')} END"

    more = f"IF(attempt < 4, '', array_join(transform(sequence(1, greatest(1, attempt div 4)), i -> char(97 + {_byte('stream', 'length(canon) + i')} % 26)), ''))"
    tail = "length(canon) - length(substring_index(canon, '.', -1)) - 1"
    df = df.withColumn("_d", F.expr(_letters("canon", "stream", "IF(kind = 'phone', attempt < 4 AND (i = 0 OR i < length(canon) - 9), i = 0)")))
    # an account keeps its country and gets the check digits that belong to the new one
    account = _letters("canon", "stream", "i < 4")
    worth = f"""aggregate(transform(split(concat(substring({account}, 5), left(canon, 2), '00'), ''), c -> IF(c RLIKE '[A-Z]', cast(ascii(c) - 55 AS string), c)),
        0, (a, x) -> IF(length(x) = 2, (a * 100 + cast(x AS int)) % 97, (a * 10 + cast(x AS int)) % 97))"""
    iban = f"concat(left(canon, 2), lpad(cast(98 - {worth} AS string), 2, '0'), substring({account}, 5))"
    hexes = f"array_join(transform(split(canon, ''), (c, i) -> IF(c = ':', c, lower(hex({_byte('stream', 'i')} % 15 + 1)))), '')"
    return df.withColumn(
        "surrogate",
        F.expr(f"""CASE kind
            WHEN 'ip' THEN {octets}
            WHEN 'card' THEN concat({body}, {_luhn(body)})
            WHEN 'phone' THEN _d
            WHEN 'ssn' THEN _d
            WHEN 'iban' THEN {iban}
            WHEN 'ip6' THEN {hexes}
            WHEN 'email' THEN concat({more}, {_letters('canon', 'stream', f'i >= {tail}')})
            WHEN 'name' THEN {by_script(name)}
            WHEN 'family' THEN {by_script(family)}
            ELSE concat({_letters('canon', 'stream')}, {more}) END"""),
    ).drop("stream", "_d")


def assign_surrogates(entities: DataFrame, key: str, rounds: int = 64) -> DataFrame:
    """``kind, canon, surrogate`` for distinct ``kind, canon``: no two surrogates are equal and
    none is a real value, of whatever kinds.  Names are drawn for once their family names have
    surrogates; so what titles a person has, the family name is the same."""
    split = entities.select("kind", "canon", F.when(F.col("kind") == "name", F.substring_index("canon", " ", -1)).alias("family"))
    families = split.where("family is not null").select(F.lit("family").alias("kind"), F.col("family").alias("canon")).distinct()
    single = split.where("family is null").select("kind", "canon").unionByName(families)
    done = _distinct_draws(single.withColumn("family", F.lit(None).cast("string")), key, rounds)
    new = done.where("kind = 'family'").select(F.col("canon").alias("family"), F.col("surrogate").alias("new"))
    names = split.join(new, "family").select("kind", "canon", F.col("new").alias("family"))
    done = stage(done.where("kind != 'family'"), "single")
    return done.unionByName(_distinct_draws(stage(names, "name"), key, rounds, done))


def _distinct_draws(entities: DataFrame, key: str, rounds: int, others: DataFrame | None = None) -> DataFrame:
    """``kind, canon, surrogate``.  Rows that collide, with each other, with real values or with
    the surrogates of ``others``, are drawn again; the least kind and canon keeps its draw."""
    left = entities.select("kind", "canon", "family", F.lit(0).alias("attempt"))
    # a draw costs far more than reading an entity, so few files must not mean few tasks
    tasks = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    done = None
    for n in range(rounds):
        drawn = stage(draw(left.repartition(tasks, "kind", "canon"), key), "draw")
        taken = entities.select(F.col("canon").alias("surrogate"))
        for more in (done, others):
            if more is not None:
                taken = taken.unionByName(more.select("surrogate"))
                taken = taken.unionByName(more.select(F.col("canon").alias("surrogate"))) if more is others else taken
        taken = taken.distinct().withColumn("real", F.lit(True))
        own = F.struct("kind", "canon")
        first = drawn.groupBy("surrogate").agg(F.min(own).alias("first"))
        judged = stage(
            drawn.join(first, "surrogate")
            .join(taken, "surrogate", "left")
            .withColumn("ok", F.col("real").isNull() & (own == F.col("first")))
            .select("kind", "canon", "family", "surrogate", "attempt", "ok"),
            "drawn",
        )
        good = judged.where("ok").select("kind", "canon", "surrogate")
        done = good if done is None else done.unionByName(good)
        left = judged.where("not ok").select("kind", "canon", "family", (F.col("attempt") + 1).alias("attempt"))
        if not left.take(1):
            return done
    raise ValueError(f"no distinct surrogates after {rounds} draws: a format has fewer values than entities")


def render(kind: Column, surface: Column, canon: Column, surrogate: Column) -> Column:
    """The surrogate in the format of this mention."""
    digits = F.array_join(
        F.zip_with(F.split(surface, "[0-9]", -1), F.split(surrogate, ""), lambda sep, d: F.concat(F.coalesce(sep, F.lit("")), F.coalesce(d, F.lit("")))), ""
    )
    spaced = F.array_join(
        F.zip_with(F.split(surface, "[A-Z0-9]", -1), F.split(surrogate, ""), lambda sep, d: F.concat(F.coalesce(sep, F.lit("")), F.coalesce(d, F.lit("")))), ""
    )
    cased = F.array_join(
        F.zip_with(F.split(surface, ""), F.split(surrogate, ""), lambda a, b: F.when((F.upper(a) == a) & (F.lower(a) != a), F.upper(b)).otherwise(b)), ""
    )
    dotted = F.when(surface.contains(". "), F.regexp_replace(surrogate, "^(\\S+) ", "$1. ")).otherwise(surrogate)
    return (
        F.when(kind.isin("phone", "card", "ssn"), digits)
        .when(kind == "iban", spaced)
        .when(kind == "email", cased)
        .when(kind == "name", dotted)
        .when(kind == "secret", F.replace(surface, canon, surrogate))
        .otherwise(surrogate)
    )


def _untitled(kind: Column, surface: Column) -> Column:
    """Given and family name of a titled mention that has both."""
    bare = F.regexp_replace(surface, r"^\S+ ", "")
    return F.when((kind == "name") & bare.contains(" "), bare)


def _repeats(text: Column, names: Column) -> Column:
    """A stretch of text with the untitled mentions of ``names`` (their surrogates beside them, the longest first) replaced."""
    whole = lambda n: F.concat(F.lit(r"(?<![\p{L}\d_-])\Q"), n, F.lit(r"\E(?![\p{L}\d_-])"))
    return F.aggregate(names, text, lambda t, n: F.regexp_replace(t, whole(n["real"]), n["new"]))


def replace_private(docs: DataFrame, *, key: str) -> DataFrame:
    """One row per input row: ``doc_id, n_entities, kinds, text`` with all entities replaced.

    ``key`` is the secret that surrogates hang on: with another key they are others.
    ``kinds`` are the distinct types found, sorted and comma-joined.  A null text stays null
    with no entities; texts without entities come back unchanged; equal texts are replaced
    alike; a null ``doc_id`` stays null; other columns are ignored; an empty table gives an
    empty one; very long texts are read whole.  Distinct entities, not mentions, are drawn for, so an address in a third of
    all rows is one row of the surrogate table."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    holds = F.coalesce(F.col("text").rlike(HINT) & F.col("text").rlike(ANY), F.lit(False))
    found = stage(
        docs.where(holds).select(
            "doc_id", "text", F.xxhash64("text").alias("same"), F.regexp_extract_all("text", F.lit(ANY), F.lit(0)).alias("found")
        ),
        "found",
    )
    mention = found.select("doc_id", "same", F.posexplode("found").alias("pos", "surface")).withColumn(
        "kind", kinds_of(F.col("surface"))
    )
    mention = stage(mention.withColumn("canon", canonical(F.col("kind"), F.col("surface"))), "mention")
    entities = stage(mention.groupBy("kind", "canon").agg(F.count("*").alias("mentions")), "entity")
    surrogate = assign_surrogates(entities.select("kind", "canon"), key).join(entities, ["kind", "canon"])
    new = (
        join_hot(mention, stage(surrogate, "surrogate"), ["kind", "canon"], "mentions")
        .select("doc_id", "same", "pos", "kind", "surface", render(F.col("kind"), F.col("surface"), F.col("canon"), F.col("surrogate")).alias("new"))
        .distinct()
        .groupBy("doc_id", "same")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "new", "kind", _untitled(F.col("kind"), F.col("surface")).alias("real")))).alias("new"))
    )
    a, b = found.alias("a"), new.alias("b")
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.same") == F.col("b.same"))
    # a person who is titled once in a text is the same person where the title is left out
    full = F.transform(F.filter("new", lambda n: n["real"].isNotNull()), lambda n: F.struct((-F.length(n["real"])).alias("by"), n["real"].alias("real"), F.regexp_replace(n["new"], r"^\S+ ", "").alias("new")))
    b = new.withColumn("names", F.array_sort(F.array_distinct(full))).alias("b")
    between = F.when(F.size("names") > 0, F.transform(F.split("text", ANY, -1), lambda t: _repeats(t, F.col("names")))).otherwise(F.split("text", ANY, -1))
    changed = a.join(b, same).select(
        "a.doc_id",
        F.size("new").cast("long").alias("n_entities"),
        F.array_join(F.array_sort(F.array_distinct("new.kind")), ",").alias("kinds"),
        F.array_join(F.zip_with(between, F.col("new.new"), lambda s, n: F.concat(s, F.coalesce(n, F.lit("")))), "").alias("text"),
    )
    plain = docs.where(~holds).select("doc_id", F.lit(0).cast("long").alias("n_entities"), F.lit("").alias("kinds"), "text")
    return changed.unionByName(plain)
