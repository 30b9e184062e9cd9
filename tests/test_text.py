"""Text recognisers: one row per arm, quirks with their flags, and random text against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from jobmart.functions import matching, vocab
from jobmart.functions import text as tx
from jobmart.functions.matching import KeywordSet, tech_keywords


def evaluate(spark, values, make):
    """Results of a text expression, in the order of the values."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in df.select("i", make(F.col("v"))).orderBy("i").collect()]


def check(spark, cases, make):
    got = evaluate(spark, list(cases), make)
    assert dict(zip(cases, got, strict=True)) == cases


def test_vocabulary_sizes():
    assert (len(vocab.TECH_KEYWORDS), len(set(vocab.TECH_KEYWORDS))) == (148, 141)
    aliases = [a for group in vocab.ROLE_ALIASES.values() for a in group]
    assert (len(vocab.ROLE_ALIASES), len(aliases), len(set(aliases))) == (43, 171, 171)


def test_keywords(spark):
    cases = {
        "python, spark and kafka": ["python", "spark", "kafka", "kafka"],
        "springboot": ["spring boot"],
        "spring - boot": ["spring boot"],
        "node.js": ["nodejs"],
        "scalable opportunity": ["scala"],  # compact matching looks inside words
        "reaction": ["react"],
        "react native": ["react", "react native"],
        "gitlab-ci": ["gitlab-ci", "gitlab"],
        "gitlab ci": ["gitlab-ci", "gitlab"],
        "github_actions": ["github actions", "github"],
        "git": ["git"],
        "legit": [],
        "aws sqs": ["aws", "aws sqs"],
        "sparkafka": ["spark", "kafka", "kafka"],
        "c#": ["c#"],
        "c#x go": ["go"],
        "go_lang": [],
        "gó": [],
        "đgo": ["go"],  # an accented letter is a boundary
        "": [],
    }
    check(spark, cases, lambda v: tech_keywords().match_all(v))


def test_keyword_quirks_and_fix(spark):
    cpp, asp = r"c\\+\\+", r"asp\\.net"
    check(spark, {"c++": [], "asp.net": [asp], "c" + "\\" * 2 + " x": [cpp]}, lambda v: tech_keywords().match_all(v))
    check(spark, {"c++": ["c++"], "c++11": [], "asp.net": ["asp.net"]}, lambda v: tech_keywords(fix_cpp=True).match_all(v))


def brute_force(keywords, text):
    found = []
    compact_text = re.sub("[^a-z0-9#+]+", "", text)
    for word in keywords:
        compact = re.sub("[^A-Za-z0-9#+]+", "", word)
        if re.search(f"(^|[^A-Za-z0-9_]){word}([^A-Za-z0-9_]|\\Z)", text):
            found.append(word)
        elif len(compact) > 4 and compact in compact_text:
            found.append(word)
    return found


def random_texts(words, count, seed, glue=(" ", "", "-", ".", "_", "/", "+", "#", "\n", "é", ", ", "1", "s", "\\")):
    rng = random.Random(seed)
    return ["".join(rng.choice(words) + rng.choice(glue) for _ in range(rng.randint(1, 7))) for _ in range(count)]


def test_keywords_equal_brute_force(spark):
    pieces = [k.replace("\\", "") for k in vocab.TECH_KEYWORDS] + ["c", "boot", "spring", "net", "asp", "hub", "x"]
    texts = random_texts(pieces, 3000, 7)
    got = evaluate(spark, texts, lambda v: tech_keywords().match_all(v))
    for text, found in zip(texts, got, strict=True):
        assert found == brute_force(vocab.TECH_KEYWORDS, text), text


def test_small_sets_with_prefixes_equal_brute_force(spark):
    words = ["c", "c#", "a b", "a-b-c", "a", "ab", "abcde", "abcdef", "bcdef", "ab cde"]
    texts = random_texts(["a", "b", "c", "c#", "abcde", "f", "ab", "cde", "bcdef"], 2000, 11)
    got = evaluate(spark, texts, lambda v: KeywordSet(words).match_all(v))
    for text, found in zip(texts, got, strict=True):
        assert found == brute_force(words, text), text


def test_first_keyword_is_first_in_the_list(spark):
    check(spark, {"kafka and java": "java", "nothing": "Unknown"}, lambda v: tech_keywords().match_first(v))


def test_roles(spark):
    cases = {
        "Senior Backend Developer": "backend",
        "Full-Stack Engineer": "fullstack",
        "FRONT END  developer": "frontend",
        "data engineer (ETL)": "data engineer",
        "AI Engineer": "ai",
        "Said Engineer": "Unknown",
        "DevOps / SRE": "site reliability",
        "Software Engineering Manager": "engineering manager",
        "Solution Architect": "solutions architect",
        "Chief Happiness Person": "Unknown",
        "Web Developer": "software",
        None: "Unknown",
        "": "Unknown",
    }
    check(spark, cases, lambda v: tx.canonical_role(tx.normalised(v)))


@pytest.mark.parametrize("field, phrases", [
    ("employment_type", vocab.EMPLOYMENT_PHRASES),
    ("location_type", vocab.LOCATION_PHRASES),
    ("seniority_level", vocab.SENIORITY_PHRASES),
])
def test_every_phrase_gives_a_label_of_its_rank_or_better(spark, field, phrases):
    """Raw field and description agree, and equal a test of each label in turn."""
    plain = [
        re.sub(r"\(\?:([a-z]+)\|.*?\)", r"\1", p).replace("\\", "").replace("?", "")
        for group in phrases.values() for p in group
    ]
    texts = plain + [p.replace(" ", "") for p in plain] + [p.replace(" ", " / ") for p in plain]
    texts += random_texts(plain, 1500, 3, (" ", "", "-", "|", "x", " | "))
    function = getattr(tx, field)
    none = F.lit(None).cast("string")
    from_description = evaluate(spark, texts, lambda v: function(none, tx.normalised(v), "default"))
    from_raw = evaluate(spark, texts, lambda v: function(v, F.lit(""), "default"))

    def expected(text):
        for label, group in phrases.items():
            pattern = "|".join(p.replace(" ", r"[ \t\n\f\r._/+:-]*") for p in group)
            if re.search(f"(^|[^A-Za-z0-9_])({pattern})([^A-Za-z0-9_]|\\Z)", text.lower()):
                return label
        return "default"

    wanted = [expected(t) for t in texts]
    assert from_raw == wanted
    if field == "seniority_level":  # years of experience come after the keywords
        from_description = [d if w != "default" else w for d, w in zip(from_description, wanted, strict=True)]
    assert from_description == wanted


def test_fields_prefer_raw_and_fall_back(spark):
    df = spark.createDataFrame(
        [("Contract", "part time"), ("unknown", "intern"), (None, "nothing"), ("Full-time", "intern"), (" N/A ", "")],
        "raw string, description string",
    )
    got = [r[0] for r in df.select(tx.employment_type(F.col("raw"), F.col("description"))).collect()]
    assert got == ["PART_TIME", "INTERNSHIP", "FULL_TIME", "FULL_TIME", "FULL_TIME"]


def test_remote_wins_over_hybrid(spark):
    cases = {"remote and office": "REMOTE", "hybrid": "HYBRID", "home": "ON_SITE", "làm việc từ xa": "REMOTE"}
    check(spark, cases, lambda v: tx.location_type(v, F.lit("")))


def _experience_brute_force(text):
    sep = r"[ \t\n\f\r._/+:-]*"
    experience = f"(experience|exp|kinh{sep}nghiem|kinh{sep}nghiệm)"
    context = f"((years?|yrs?|nam|năm){sep}(of{sep})?{experience}|{experience})"

    def has(pattern):
        return re.search(f"(^|[^A-Za-z0-9_])({pattern})([^A-Za-z0-9_]|\\Z)", text)

    for low, high, label in ((0, 1, "Entry"), (1, 2, "Junior"), (2, 4, "Mid-Level")):
        if has(f"{low}{sep}(-|~|to|den|đến){sep}{high}{sep}({context})"):
            return label
    for number, label in (("4|5|6|7|8|9|[1-9][0-9]", "Senior"), ("2|3", "Mid-Level"), ("1", "Junior"), ("0", "Entry")):
        plus = rf"{sep}(\+|plus)?"
        if has(f"({number}){plus}{sep}({context})|({context}){sep}({number}){plus}"):
            return label
    return "Unknown"


def test_experience(spark):
    check(spark, {
        "0-1 year of experience": "Entry", "1 ~ 2 yrs exp": "Junior", "2 to 4 years experience": "Mid-Level",
        "3-5 years experience": "Senior", "kinh nghiệm 2 năm": "Mid-Level", "12+ years of experience": "Senior",
        "experience: 1": "Junior", "0 năm kinh nghiệm": "Entry", "5 years": "Unknown", "100 years experience": "Unknown",
    }, tx.experience_level)


def test_experience_equals_brute_force(spark):
    pieces = ["0", "1", "2", "3", "4", "5", "12", "100", "years", "year", "yrs", "năm", "of", "experience", "exp",
              "kinh nghiệm", "plus", "to", "đến", "~", "-", "and"]
    texts = random_texts(pieces, 4000, 5, (" ", " ", "", "-", "+", " + ", "_", "x"))
    got = evaluate(spark, texts, tx.experience_level)
    assert got == [_experience_brute_force(t) for t in texts]


def _salary_brute_force(text):
    sep, amount, sign = r"[ \t\n\f\r._/+:-]*", "[0-9]+([.,][0-9]+)?", "[$€£]"
    unit, until = "(usd|vnd|vnđ|trieu|triệu|million)", f"{sep}(to|den|đến){sep}({sign}{sep})?{amount}"
    pattern = "|".join([
        f"(up{sep}to|upto|from|to|tu|từ|den|đến){sep}({sign}{sep})?{amount}({until})?({sep}{unit})?",
        f"{sign}{sep}{amount}({until})?({sep}{unit})?",
        f"{amount}{sep}{unit}({until}{sep}{unit}?)?",
        f"{amount}{until}({sep}{unit})?",
        f"negotiable|competitive|thoa{sep}thuan|thỏa{sep}thuận",
    ])
    found = re.search(pattern, text)
    return found[0] if found else "Unknown"


def test_salary(spark):
    none = F.lit(None).cast("string")
    check(spark, {
        "pays up to $2,000 usd now": "up to $2,000 usd", "từ 10 đến 20 triệu": "từ 10 đến 20 triệu",
        "into 2023": "to 2023", "1.5.2 usd": "5.2 usd", "competitive": "competitive", "none": "Unknown",
    }, lambda v: tx.salary_phrase(none, v))
    check(spark, {"  1000 USD ": "1000 USD", "n/a": "Unknown", "Negotiable": "Negotiable"},
          lambda v: tx.salary_phrase(v, F.lit("")))


def test_salary_equals_brute_force(spark):
    pieces = ["10", "2,000", "1.5", "20", "up", "to", "upto", "from", "từ", "đến", "$", "€", "usd", "vnđ", "triệu",
              "million", "thỏa thuận", "negotiable", "x"]
    texts = random_texts(pieces, 4000, 9, (" ", " ", "", "-", ".", ",", "/"))
    got = evaluate(spark, texts, lambda v: tx.salary_phrase(F.lit(None).cast("string"), v))
    assert got == [_salary_brute_force(t) for t in texts]


def test_long_separator_runs_stay_linear(spark):
    """Each of these takes minutes when repetitions can be divided up in many ways."""
    run = "-+ " * 30_000
    texts = [f"0{run}", f"5{run}", f"experience{run}", f"10{run}", "1" * 60_000, f"full{run}", f"trên{run}5{run}"]
    for make in (
        tx.experience_level,
        lambda v: tx.salary_phrase(F.lit(None).cast("string"), v),
        lambda v: tx.employment_type(F.lit(None).cast("string"), v),
        lambda v: tx.seniority_level(F.lit(None).cast("string"), v),
        lambda v: F.size(tech_keywords().match_all(v)),
    ):
        assert len(evaluate(spark, texts, make)) == len(texts)


def test_keys_and_numbers(spark):
    slugs = {
        "  ACME, Inc. ": "acme-inc", "acme inc": "acme-inc", "Công ty Đá": "c-ng-ty", "---": "unknown",
        None: "unknown", "": "unknown", "a\n": "a",
    }
    check(spark, slugs, tx.slug)
    check(spark, {None: "ad921d60486366258809553a3db49a4a"}, tx.slug_md5_key)
    numbers = {
        "12": 12, " 7 ": 7, "12.6": 13, "1,234": 0, "abc": 0, "": 0, None: 0, "1e3": 1000, "-3.5": -4,
        "99999999999": 0,
    }
    check(spark, numbers, tx.lenient_int)


def test_fallbacks(spark):
    other = F.lit("fb")
    check(spark, {None: "fb", " NULL ": "fb", " x ": "x"}, lambda v: tx.known_text_or(v, other))
    check(spark, {None: "fb", "none": "fb", " x ": " x "}, lambda v: tx.known_value_or(v, other))
    check(spark, {"n/a": "fb", "x": "label"}, lambda v: tx.known_label_or(v, F.lit("label"), other))
    check(spark, {"x": "fb"}, lambda v: tx.known_label_or(v, F.lit(""), other))


def test_separators_in_keywords(spark):
    """With the flag, white space of any length stands for the space of a keyword; by plain patterns on random text."""
    words = ["go", "ci cd", "go ci", "r", "r go", "ci", "c d e"]
    draw, texts = random.Random(6), []
    for _ in range(300):
        texts.append("".join(draw.choice(["go", "ci", "cd", "r", "c", "d", "e", " ", "  ", "\n", "\t ", "x", ".", "_"]) for _ in range(draw.randrange(1, 14))))
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for separators in (True, False):
        found = KeywordSet(words, separators).match_all(F.col("t"))
        for r in df.select("t", found.alias("got")).collect():
            wanted = [
                w for w in words
                if re.search(rf"(?<![A-Za-z0-9_]){w.replace(' ', r'[ \t\n\x0b\f\r]+') if separators else w}(?![A-Za-z0-9_])", r.t)
            ]
            assert r.got == wanted, (r.t, separators)
    assert "spring boot" in spark.createDataFrame([("spring\n boot",)], "t string").select(
        tech_keywords(fix_separators=True).match_all(F.col("t"))).first()[0]


def test_long_keywords_are_looked_for_at_rare_letters_only(spark):
    """Every form that occurs is found, next to and inside of others, though most letters of a text are passed over."""
    forms = list(matching.tech_keywords()._long)
    pattern, _ = matching._anchored_pattern(forms)
    assert not set("aeiorst") & set(pattern.split("]")[0])
    texts = [a + b + c for a in forms for b in ("", "x", "gitlab", "ci") for c in ("", "q", a)]
    compact = spark.createDataFrame([(t,) for t in texts], "compact string")
    found = matching.KeywordSet(forms).match_all(F.lit(""), F.col("compact"))
    assert {t: set(f) for t, f in compact.select("compact", found).collect()} == {t: {f for f in forms if f in t} for t in texts}
