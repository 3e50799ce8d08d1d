"""PII surrogates with DataFrame operations only.

Patterns find entities; each gets a replacement derived from a key and the entity's canonical form, of the same type,
gender, script and format. The same entity always gets the same surrogate, and a check over all distinct entities
makes sure that two different ones never share a surrogate and that no surrogate is an entity of the texts.
Of a name each word has its own surrogate, so that "Anna Smith", "Mrs Smith" and a later "Smith" or "Anna" of the same text agree.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.llm.common import written

# Given names by script and gender ("n": of any), syllables of names by script, endings of made-up given names, titles by gender.
NAMES = {
    ("latin", "f"): ["Alice", "Amelia", "Anna", "Barbara", "Camille", "Catherine", "Charlotte", "Chloe", "Clara", "Elena", "Elizabeth", "Emily", "Emma", "Eva", "Hannah", "Helen", "Ines", "Ingrid", "Isabel", "Jane", "Jennifer", "Julia", "Karen", "Laura", "Linda", "Lisa", "Louise", "Lucy", "Margaret", "Maria", "Marie", "Mary", "Nora", "Olivia", "Patricia", "Paula", "Rachel", "Sarah", "Sofia", "Sophie", "Susan", "Ursula"],
    ("latin", "m"): ["Adam", "Alexander", "Andrew", "Antonio", "Benjamin", "Bruno", "Carlos", "Charles", "Daniel", "David", "Edward", "Felix", "Francesco", "George", "Henry", "Hugo", "Jack", "Jacob", "James", "Johann", "John", "Jonas", "Joseph", "Juan", "Klaus", "Leon", "Lucas", "Luis", "Marco", "Martin", "Matthew", "Michael", "Oliver", "Oscar", "Paul", "Peter", "Pierre", "Richard", "Robert", "Simon", "Stefan", "Thomas", "Tom", "William"],
    ("latin", "n"): ["Alex", "Andrea", "Casey", "Chris", "Jamie", "Kim", "Riley", "Robin", "Sam", "Sasha", "Toni"],
    ("cyrillic", "f"): ["Анна", "Вера", "Дарья", "Екатерина", "Елена", "Ирина", "Мария", "Наталья", "Нина", "Ольга", "Софья", "Татьяна"],
    ("cyrillic", "m"): ["Александр", "Алексей", "Андрей", "Антон", "Борис", "Дмитрий", "Иван", "Илья", "Никита", "Олег", "Павел", "Роман", "Сергей", "Юрий"],
    ("cyrillic", "n"): ["Женя", "Саша", "Валя"],
    ("greek", "f"): ["Άννα", "Ελένη", "Ειρήνη", "Κατερίνα", "Μαρία", "Σοφία"],
    ("greek", "m"): ["Αλέξανδρος", "Γιάννης", "Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Παύλος"],
}
SYLLABLES = {
    "latin": ["ba", "den", "fel", "gar", "han", "ker", "lan", "mor", "nel", "ros", "san", "ter", "val", "win", "zer", "dol"],
    "cyrillic": ["ба", "вер", "гор", "дан", "зим", "кор", "лан", "мир", "нел", "рос", "сан", "тер", "вал", "бел", "дол", "мар"],
    "greek": ["βα", "δεν", "φελ", "γαρ", "καν", "κερ", "λαν", "μορ", "νελ", "ροδ", "σαν", "τερ", "βαλ", "μιν", "ζερ", "δολ"],
    "armenian": ["բա", "դեն", "ֆել", "գար", "հան", "կեր", "լան", "մոր", "նել", "ռոս", "սան", "տեր", "վալ", "մին", "զեր", "դոլ"],
}
ENDINGS = {
    ("latin", "f"): "ia", ("latin", "m"): "o", ("latin", "n"): "y", ("cyrillic", "f"): "а", ("cyrillic", "m"): "ий", ("cyrillic", "n"): "и",
    ("greek", "f"): "ία", ("greek", "m"): "ος", ("greek", "n"): "ι", ("armenian", "n"): "ե",
}
TITLES = {"f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Г-жа", "Κυρία"], "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Г-н", "Κύριος"], "n": ["Dr", "Prof"]}
# How names end that no list holds.
FEMALE = "(?:a|а|я|α|η|ω|ά|ή|ώ)$"
MALE = r"(?:o|[бвгджзйклмнпрстфхцчшщ]|ς)$"

_TITLE = "(?:" + "|".join(t for g in TITLES.values() for t in g) + r")\.?"
_GIVEN = "(?:" + "|".join(n for g in NAMES.values() for n in g) + ")"
_NAME = r"\p{Lu}(?:\p{Ll}+|['’]\p{Lu}\p{Ll}+)(?:['’-]?\p{Lu}\p{Ll}+)*+"
# Small words inside a name.
_MIDDLE = rf"(?: (?:{_GIVEN}|\p{{Lu}}\.|von|van|de|der|den|del|di|da|dos|ter|bin)(?= )){{0,3}}"
# What stands before a name that has no title, up to the blank.
_CUE = r"(?:[Nn]ame is|[Nn]ame:|[Dd]ear|[Rr]egards,|[Ss]incerely,|[Ss]igned,|[Aa]uthor:|[Cc]ontact:|[Aa]ttn:|[Pp]atient:)"
#: In the order in which they are tried at a place of the text.
PATTERNS = {
    "passport": r"(?<![\p{L}])(?i:passport(?: no\.?| number)?[:#]? ?)(?=[A-Z]*\d)[A-Z0-9]{6,9}(?![A-Za-z0-9])",
    "secret": r"(?i:password|passwd|token|secret|api_?key) ?[=:] ?\"?[A-Za-z0-9+/_-]{8,}+\"?|(?<![A-Z0-9])AKIA[A-Z0-9]{16}(?![A-Z0-9])",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)",
    "phone": r"(?<![\d+])\+?\d{1,3}[ .-]?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<!\d)\+\d{1,3}(?:[ .-]?\d{2,4}){3,4}(?!\d)|(?<![\d(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)",
    "iban": r"(?<![A-Z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Z0-9])",
    "name": rf"(?<![\p{{L}}])(?:(?:{_TITLE} ){{1,2}}{_NAME}(?:{_MIDDLE} {_NAME})?|(?=\p{{Lu}}){_GIVEN}{_MIDDLE} {_NAME}|(?<={_CUE} ){_NAME}{_MIDDLE} {_NAME})(?![\p{{L}}])",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What every entity holds: texts without it are left alone after one scan.
SIGN = rf"[@\d]|(?<![\p{{L}}])(?:(?=\p{{Lu}})(?:{_TITLE}|{_GIVEN})|{_CUE}) \p{{L}}|[=:] ?\"?[A-Za-z0-9+/_-]{{8}}"
#: Replacements that changed surrogates may need on the driver before a join is used instead.
MAP_LIMIT = 10_000
ATTEMPTS = 12
#: Attempts of a given name that come from the list; later ones are made of syllables.
LISTED = 2


def kind(entity: Column) -> Column:
    """The type of an entity: that of the first pattern that fits all of it."""
    named = F.when(entity.rlike(rf"^(?:{_TITLE} )*{_NAME}(?:{_MIDDLE} {_NAME})?$"), F.lit("name"))
    return F.coalesce(*[F.when(entity.rlike(f"^(?:{p})$"), F.lit(k)) for k, p in PATTERNS.items()], named, F.lit("secret"))


def canonical(type_: Column, entity: Column) -> Column:
    """One form for all ways in which an entity is written."""
    return (
        F.when(type_.isin("phone", "ssn", "card"), F.regexp_replace(entity, r"\D", ""))
        .when(type_ == "iban", F.regexp_replace(entity, " ", ""))
        .when(type_.isin("email", "given", "family", "initial"), F.lower(entity))
        .when(type_ == "passport", F.regexp_extract(entity, "([A-Z0-9]+)$", 1))
        .when(type_ == "secret", F.regexp_replace(F.regexp_replace(entity, r"^[^=:]*[=:] ?", ""), '"', ""))
        .otherwise(entity)
    )


def parts(entity: Column, families: Column | None = None) -> Column:
    """(type, e) of the words of a name, or of an entity of another type as a whole.

    A name's words are title, given, family, initial or particle. The last word is the family name, but for a common given name
    after a title alone, and for a single word that isn't among `families`.
    """
    words = F.split(entity, " ")
    single = F.lit(False) if families is None else (F.size(words) == 1) & ~F.array_contains(families, entity)

    def word(w: Column, i: Column) -> Column:
        last = i == F.size(words) - 1
        type_ = (
            F.when(~last & w.rlike(f"^{_TITLE}$"), "title").when(w.rlike(r"^\p{Lu}\.$"), "initial").when(w.rlike(r"^\p{Ll}"), "particle")
            .when(last & ~single & ~entity.rlike(rf"^(?:{_TITLE} )+{_GIVEN}$"), "family").otherwise("given")
        )
        return F.struct(type_.alias("type"), w.alias("e"))

    return bound(kind(entity), lambda t: F.when(t == "name", F.transform(words, word)).otherwise(F.array(F.struct(t.alias("type"), entity.alias("e")))))


def _pick(values: list[str], hex_: Column, at: int) -> Column:
    """One of the values by three hex digits from `at` on."""
    number = F.conv(F.substring(hex_, at, 3), 16, 10).cast("int")
    return F.get(F.array(*map(F.lit, values)), number % len(values))


def shaped(entity: Column, hex_: Column, fixed: int | Column = 0) -> Column:
    """The entity with each digit and Latin letter replaced by another of its class, case kept; marks and the first `fixed` of them stay.

    The k-th letter or digit depends on the k-th hex digits only, so an entity written with other separators has the same replacement.
    """
    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("k"))

    def step(a: Column, c: Column) -> Column:
        number = F.conv(F.substr(hex_, a["k"] * 2 % 126 + 1, F.lit(2)), 16, 10).cast("int")
        new = (
            F.when(c.rlike("[0-9]"), (number % 10).cast("string"))
            .when(c.rlike("[a-z]"), F.char(number % 26 + 97))
            .when(c.rlike("[A-Z]"), F.char(number % 26 + 65))
        )
        counted = c.rlike("[0-9A-Za-z]")
        return F.struct(F.concat(a["out"], F.when(counted & (a["k"] >= fixed), new).otherwise(c)).alias("out"), (a["k"] + counted.cast("int")).alias("k"))

    return F.aggregate(F.split(entity, ""), zero, step, lambda a: a["out"])


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once and written once in the plan, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def luhn(card: Column) -> Column:
    """The check digit that the other digits of a card number ask for: from the right every second one is doubled."""
    from_right = F.reverse(F.split(F.regexp_replace(card, r"\D|\d\D*$", ""), ""))
    doubled = F.transform(from_right, lambda c, k: F.coalesce(F.try_to_number(c, F.lit("9")).cast("int"), F.lit(0)) * F.when(k % 2 == 0, 2).otherwise(1))
    total = F.aggregate(doubled, F.lit(0), lambda a, v: a + v % 10 + F.when(v > 9, 1).otherwise(0))
    return ((10 - total % 10) % 10).cast("string")


def checked_card(old: Column, new: Column) -> Column:
    """new with the check digit that fits, if that of old does."""
    right = luhn(old) == F.regexp_extract(old, r"(\d)\D*$", 1)
    return bound(new, lambda n: F.when(right, F.concat(F.substr(n, F.lit(1), F.length(n) - 1), luhn(n))).otherwise(n))


def checked_iban(new: Column) -> Column:
    """new with the two check digits that its country and account have: 98 less the number modulo 97, letters counting from 10 on."""
    moved = lambda n: F.regexp_replace(F.concat(F.substr(n, F.lit(5)), F.substr(n, F.lit(1), F.lit(2)), F.lit("00")), "[^0-9A-Z]", "")
    step = lambda a, c: F.when(c.rlike("[A-Z]"), (a * 100 + F.ascii(c) - 55) % 97).when(c != "", (a * 10 + F.ascii(c) - 48) % 97).otherwise(a)
    rest = lambda n: F.aggregate(F.split(moved(n), ""), F.lit(0), step)
    return bound(new, lambda n: F.concat(F.substr(n, F.lit(1), F.lit(2)), F.lpad((98 - rest(n)).cast("string"), 2, "0"), F.substr(n, F.lit(5))))


def surrogate(type_: Column, entity: Column, canon: Column, key: str, attempt: Column) -> Column:
    """The replacement of an entity as it is written, before the check for clashes."""
    seed = F.concat_ws("\u0001", F.lit(key), attempt.cast("string"), type_, canon)
    return bound(F.concat(F.sha2(seed, 256), F.sha2(F.concat(F.lit("2"), seed), 256)), lambda hex_: _surrogate(type_, entity, canon, hex_, attempt))


def _capital(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), F.substr(word, F.lit(2)))


def _name(type_: Column, canon: Column, hex_: Column, attempt: Column) -> Column:
    """A word of a name: of the script of the old one, a given name also of its gender, a family name with its hyphen or its ending."""
    script = F.when(canon.rlike(r"\p{IsCyrillic}"), "cyrillic").when(canon.rlike(r"\p{IsGreek}"), "greek").when(canon.rlike(r"\p{IsArmenian}"), "armenian").otherwise("latin")
    among = lambda names: F.contains(F.lit(f" {' '.join(names).lower()} "), F.concat(F.lit(" "), canon, F.lit(" ")))
    gender = F.coalesce(*[F.when(among(names), g) for (_, g), names in NAMES.items()], F.when(canon.rlike(FEMALE), "f").when(canon.rlike(MALE), "m"), F.lit("n"))
    by = lambda table, k: reduce(lambda c, x: F.when(k == F.lit(x if isinstance(x, str) else " ".join(x)), F.lit(table[x] if isinstance(table[x], str) else " ".join(table[x]))).otherwise(c), table, F.lit(None))

    def made(syllables: Column, kind_: Column) -> Column:
        at = lambda i: F.get(syllables, F.conv(F.substring(hex_, 4 + 3 * i, 3), 16, 10).cast("int") % F.size(syllables))
        more = F.when(attempt >= LISTED, F.concat(at(5), at(6))).otherwise("")
        hyphen = F.when(canon.contains("-"), F.concat(F.lit("-"), _capital(at(3)))).otherwise(at(3))
        ending = F.when(canon.rlike("(?:ва|на|ая)$"), "ова").when(canon.rlike("(?:[ое]в|ин|ий)$"), "ов").otherwise("")
        family = F.concat(_capital(at(0)), at(1), at(2), hyphen, at(4), more, ending)
        listed = F.split(by(NAMES, kind_), " ")
        number = F.conv(F.substring(hex_, 1, 3), 16, 10).cast("int")
        given = F.coalesce(F.when(attempt < LISTED, F.get(listed, number % F.size(listed))), F.concat(_capital(at(0)), at(1), at(2), F.coalesce(by(ENDINGS, kind_), F.lit(""))))
        return F.when(type_ == "family", family).when(type_ == "given", given).otherwise(F.concat(F.upper(F.substring(at(0), 1, 1)), F.lit(".")))

    return bound(F.split(by(SYLLABLES, script), " "), lambda syllables: bound(F.concat_ws(" ", script, gender), lambda kind_: made(syllables, kind_)))


def _surrogate(type_: Column, entity: Column, canon: Column, hex_: Column, attempt: Column) -> Column:
    octets = [F.conv(F.substring(hex_, 2 * k + 1, 2), 16, 10) for k in range(4)]
    domain = F.regexp_extract(entity, r"@(.*)\.[^.]*$", 1)
    email = F.concat(shaped(F.regexp_extract(entity, "^([^@]*)@", 1), hex_), F.lit("@"), shaped(domain, F.substring(hex_, 41, 88)), F.regexp_extract(entity, r"(\.[^.]*)$", 1))
    before = F.regexp_extract(entity, r'^([^=:]*[=:] ?"?)', 1)
    secret = F.concat(before, shaped(F.substr(entity, F.length(before) + 1), hex_, F.when(canon.startswith("AKIA"), 4).otherwise(0)))
    return (
        F.when(type_ == "ip", F.concat_ws(".", *octets)).when(type_ == "email", email).when(type_.isin("given", "family", "initial"), _name(type_, canon, hex_, attempt))
        .when(type_.isin("title", "particle"), entity).when(type_ == "passport", F.concat(F.substr(entity, F.lit(1), F.length(entity) - F.length(canon)), shaped(canon, hex_)))
        .when(type_ == "secret", F.when(entity.startswith("AKIA"), shaped(entity, hex_, 4)).otherwise(secret))
        .when(type_ == "card", checked_card(entity, shaped(entity, hex_, 1))).when(type_ == "iban", checked_iban(shaped(entity, hex_, 2)))
        .when(type_ == "phone", shaped(entity, hex_, 1)).otherwise(shaped(entity, hex_))
    )


def entities(text: Column) -> Column:
    """The entities of a text in their order, without names that stand alone after the full one."""
    return F.when(text.rlike(SIGN), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def followed(text: Column, base: Column) -> Column:
    """(words, families): family and common given names of a text's entities, which may stand alone further on, and the family names among them.

    A word that the text also has in small letters is a common word and isn't followed.
    """
    names = F.flatten(F.transform(base, lambda e: F.when(e.rlike(r"^\p{Lu}.* \p{Lu}"), parts(e)).otherwise(F.array().cast("array<struct<type:string,e:string>>"))))
    words = lambda ps, t: F.array_distinct(F.transform(F.filter(ps, lambda p: t(p)), lambda p: p["e"]))
    alone = lambda w: ~F.rlike(text, F.concat(F.lit(r"(?<![\p{L}])"), F.lower(w), F.lit(r"(?![\p{L}])")))
    known = lambda p: (p["type"] == "family") | (p["type"] == "given") & p["e"].rlike(f"^{_GIVEN}$")
    return bound(names, lambda ps: F.struct(F.filter(words(ps, known), alone).alias("words"), words(ps, lambda p: p["type"] == "family").alias("families")))


def clashes(docs: DataFrame, text: str, key: str) -> tuple[DataFrame, int]:
    """(type, canon, attempt) of the entities, names by their words, whose first surrogate can't stay, and their number.

    Of entities that share a surrogate the smallest keeps it; the others, and those whose surrogate is itself an entity,
    get the next attempt, until none is left.
    """
    found = docs.select(F.explode(entities(F.col(text))).alias("e")).select(F.explode(parts(F.col("e"))).alias("p")).select("p.type", "p.e").where("type not in ('title', 'initial', 'particle')")
    each = written(found.select("type", canonical(F.col("type"), F.col("e")).alias("canon"), "e").groupBy("type", "canon").agg(F.min("e").alias("e")), "entities")
    taken = written(each.select("type", "canon", bound(surrogate(F.col("type"), F.col("e"), F.col("canon"), key, F.lit(0)), lambda s: canonical(F.col("type"), s)).alias("s")), "surrogates")

    current = taken.withColumn("attempt", F.lit(0))
    for k in range(1, ATTEMPTS + 1):
        shared = current.groupBy("type", "s").agg(F.min(F.struct("attempt", "canon")).alias("keeps"), F.count("*").alias("n")).where("n > 1").select("type", "s", "keeps.canon")
        bad = current.join(shared.withColumnRenamed("canon", "keeper"), ["type", "s"]).where("canon <> keeper").select("type", "canon")
        real = current.join(each.select("type", F.col("canon").alias("s")), ["type", "s"], "left_semi").select("type", "canon")
        bad = written(bad.union(real).distinct(), f"clashes{k}")
        if not bad.limit(1).count():
            break
        again = bad.join(each, ["type", "canon"]).select("type", "canon", bound(surrogate(F.col("type"), F.col("e"), F.col("canon"), key, F.lit(k)), lambda s: canonical(F.col("type"), s)).alias("s"), F.lit(k).alias("attempt"))
        current = written(current.join(bad, ["type", "canon"], "left_anti").unionByName(again), f"attempt{k}")
    else:
        raise RuntimeError(f"surrogates still clash after {ATTEMPTS} attempts; use types with longer formats or another key")
    moved = current.where("attempt > 0").select("type", "canon", "attempt")
    return moved, moved.count()


def pseudonymize(docs: DataFrame, key: str = "public-example-key", text: str = "text", doc_key: str = "doc_id", count: str = "n_entities") -> DataFrame:
    """All columns, with the text's entities replaced, and their number in a new column `count`, last.

    Where the table has a column of that name already, the new one gets underscores at its end until it is free; columns of
    the table are never read or changed but for the text. Null texts stay null with no entities, empty texts stay empty. Repeated rows are changed alike. The key is a secret of
    the caller. Where some surrogates clash, their later attempts come with a map on each row's side if they are few, else
    by a join of the entities.
    """
    moved, n = clashes(docs, text, key)
    while count in docs.columns:
        count += "_"
    hashed, joined_key, attempts_of, made, base = (f"{x}_{uuid.uuid4().hex}" for x in ("hash", "key", "attempts", "made", "base"))
    d = docs.withColumn(base, entities(F.col(text)))
    attempt_of = None
    if n and n <= MAP_LIMIT:
        pairs = {(r["type"], r["canon"]): r["attempt"] for r in moved.collect()}
        attempts = F.create_map(*[F.lit(x) for (t, c), a in pairs.items() for x in (f"{t}\u0001{c}", a)])
        attempt_of = lambda t, c: F.coalesce(F.try_element_at(attempts, F.concat_ws("\u0001", t, c)), F.lit(0))
    elif n:
        # By a hash of key and text: a null key is one of many, and equal rows need the same map.
        d = d.withColumn(hashed, F.xxhash64(F.col(doc_key), F.col(text)))
        e = d.select(F.col(hashed).alias(joined_key), F.explode(base).alias("e")).select(joined_key, F.explode(parts(F.col("e"))).alias("p")).select(joined_key, "p.type", "p.e")
        e = e.withColumn("canon", canonical(F.col("type"), F.col("e"))).join(moved, ["type", "canon"]).select(joined_key, F.concat_ws("\u0001", "type", "canon").alias("n"), "attempt").distinct()
        maps = e.groupBy(joined_key).agg(F.map_from_entries(F.collect_list(F.struct("n", "attempt"))).alias(attempts_of))
        d = d.join(maps, F.col(hashed) == F.col(joined_key), "left").drop(joined_key)
        attempt_of = lambda t, c: F.coalesce(F.try_element_at(F.col(attempts_of), F.concat_ws("\u0001", t, c)), F.lit(0))

    attempt = lambda t, c: attempt_of(t, c) if attempt_of else F.lit(0)
    one = lambda p: bound(canonical(p["type"], p["e"]), lambda c: surrogate(p["type"], p["e"], c, key, attempt(p["type"], c)))

    def rewritten(words: Column, families: Column, pattern: Column) -> Column:
        found = F.when(F.size(words) > 0, F.regexp_extract_all(F.col(text), pattern, F.lit(0))).otherwise(F.col(base))
        new = F.transform(found, lambda e: F.array_join(F.transform(parts(e, families), one), " "))
        between = F.split(F.col(text), pattern, -1)
        return bound(new, lambda n: F.struct(F.array_join(F.transform(between, lambda b, i: F.concat(b, F.coalesce(F.get(n, i), F.lit("")))), "").alias("text"), F.size(n).cast("long").alias("n")))

    def whole(names: Column) -> Column:
        alone = F.concat(F.lit(ANY + r"|(?<![\p{L}])(?:"), F.array_join(names["words"], "|"), F.lit(r")(?![\p{L}])"))
        return bound(F.when(F.size(names["words"]) > 0, alone).otherwise(F.lit(ANY)), lambda pattern: rewritten(names["words"], names["families"], pattern))

    unchanged = F.struct(F.col(text).alias("text"), F.lit(0).cast("long").alias("n"))
    # One expression whose values are bound: a column read inside a lambda could be computed again for each element.
    d = d.withColumn(made, F.when(F.size(base) > 0, bound(followed(F.col(text), F.col(base)), whole)).otherwise(unchanged))
    return d.withColumn(text, F.col(made)["text"]).withColumn(count, F.col(made)["n"]).select(*docs.columns, count)
