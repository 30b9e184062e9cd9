import re

from jobmart.llm import decontaminate
from jobmart.llm.queries import QUERIES
from jobmart.llm.templates import NAME, NUMBER, UNIT, template, templates

PLAIN = "nothing in this line has anything to do with what is asked in any benchmark at all "
ITEM = ("A train leaves the old station of Berlin at 9 hours and covers 120 km before it meets a second train "
        "that started from Munich with 45 passengers on board; how far is Berlin now?")
CHANGED = ("A train leaves the old station of Paris at 7 hours and covers 350 miles before it meets a second train "
           "that started from Lyon with 80 passengers on board; how far is Paris now?")
SAME = "Each of 5 rows has 5 seats and each of 5 seats has 5 legs and of 5 legs all 5 are red so say 5 now"
OTHER = "Each of 1 rows has 2 seats and each of 3 seats has 4 legs and of 5 legs all 6 are red so say 7 now"


def test_placeholders():
    found = template("We met Anna, who ran 3,000.5 km. Then Bob ran 12 in ALL. Über Zürich 7x.".encode())
    assert found.kinds.tolist() == [0, 0, NAME, 0, 0, NUMBER, UNIT, 0, NAME, 0, NUMBER, UNIT, 0, 0, NAME, NUMBER]
    assert template("Anna RAN, over there".encode()).tokens.tolist() == template("anna ran over  there!".encode()).tokens.tolist()
    assert len(template(b"")) == len(template(None)) == len(template(b" .,- ")) == 0


def _found(spark, docs, items):
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    i = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): r for r in decontaminate.passages(d, i).collect()}


def test_reparameterised_questions_are_caught(spark):
    docs = [PLAIN + ITEM, PLAIN * 3 + CHANGED + PLAIN, PLAIN, ITEM[: len(ITEM) // 4], "x " + ITEM[30:120], None, ""]
    found = _found(spark, docs, [ITEM, None, "short one", ""])
    assert set(found) == {(0, 0), (1, 0), (4, 0)}
    assert found[0, 0]["verbatim"] and not found[1, 0]["verbatim"]
    assert found[0, 0]["matched"] >= found[0, 0]["item_tokens"] - 1


def test_slots_must_be_replaced_consistently(spark):
    found = _found(spark, [SAME, OTHER, CHANGED], [SAME, ITEM])
    assert set(found) == {(0, 0), (2, 1)}


def test_equal_items_are_one_and_short_items_work(spark):
    found = _found(spark, [PLAIN + "who wrote the blue book"], ["who wrote the blue book", "who wrote the blue book"])
    assert set(found) == {(0, 0)}


def test_the_query_finds_every_planted_passage(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    words = lambda t: re.findall(r"\w+", t.lower())
    by = {}
    for j, t in items.items():
        w = words(t)
        for k in range(len(w) - 7):
            by.setdefault(tuple(w[k : k + 8]), set()).add(j)
    near = set()
    for i, t in docs.items():
        w = words(t)
        near |= {(i, j) for k in range(len(w) - 7) for j in by.get(tuple(w[k : k + 8]), ())}
    whole = {(i, j) for i, t in docs.items() for j, x in items.items() if x in t}
    found = {(r["doc_id"], r["item_id"]) for r in QUERIES["op6_decontamination"](spark, folder).collect()}
    assert whole and whole <= found <= near


def test_values_may_change_their_number_of_words(spark):
    item = ("the old coach to the port of Paris left the yard with 12 crates of fresh plums for the fair while the "
            "young clerk from the town of Lyon wrote every crate down in a long green book")
    changed = item.replace("Paris", "New York").replace("12", "one hundred and five").replace("Lyon", "San Jose Del Cabo")
    found = _found(spark, [PLAIN + changed + " " + PLAIN, PLAIN + item], [item])
    assert set(found) == {(0, 0), (1, 0)}
    assert not found[0, 0]["verbatim"] and found[1, 0]["verbatim"]
    assert found[0, 0]["matched"] == found[0, 0]["item_tokens"]


def test_names_at_the_start_of_sentences_are_replaced(spark):
    item = "Anna has 5 red apples now. Anna gives 2 of them away. Anna eats 1 at noon. Anna sells the rest today."
    changed = item.replace("Anna", "Boris")
    mixed = changed.replace("Boris gives", "Carla gives").replace("Boris eats", "Dora eats").replace("Boris sells", "Emil sells")
    found = _found(spark, [PLAIN + ". " + changed, PLAIN + ". " + mixed, PLAIN + ". " + item + " Rose met Anna"], [item])
    assert set(found) == {(0, 0), (2, 0)}
    assert found[2, 0]["verbatim"] and not found[0, 0]["verbatim"]


def test_pieces_of_different_places_are_not_added_up(spark):
    words = [f"w{i}x" for i in range(40)]
    doc = " ".join(words[:9]) + " " + PLAIN * 4 + " ".join(words[20:29])
    assert not _found(spark, [doc, " ".join(words[20:30] + words[:10])], [" ".join(words)])


def test_items_without_plain_windows_are_found_as_a_whole(spark):
    table_item = "Berlin 12 17 Paris 40 41 Rome 5 6 7 8 Oslo 9 10 11 12"
    items = ["Who wrote it?", "12 + 17 * 3 = ?", table_item, "今天北京有多少人？", "小明有十二个苹果，他给了小红三个苹果，还剩下多少个苹果？"]
    docs = [PLAIN + x + " " + PLAIN for x in items] + [PLAIN + "Who wrote 12 17 4 今天北京有多少", PLAIN + table_item[:-3]]
    found = _found(spark, docs, items)
    assert set(found) == {(i, i) for i in range(len(items))}
    assert all(r["verbatim"] and r["matched"] == r["item_tokens"] for r in found.values())


def test_letters_of_unspaced_scripts_are_tokens():
    found = template("小明有12个apple，「苹果」。ภาษา 𠀀𠀁x".encode())
    assert len(found) == 3 + 1 + 1 + 1 + 2 + 4 + 3
    assert found.kinds.tolist().count(NUMBER) == 1
    assert template("苹果，明".encode()).tokens.tolist() == template("苹果 明。".encode()).tokens.tolist()


def test_capitals_beyond_ascii():
    found = template("Тогда Анна и МИР. Η Αθήνα; chị Đặng ở Ấn Độ và É".encode())
    assert found.kinds.tolist() == [0, NAME, 0, 0, 0, NAME, 0, NAME, 0, NAME, NAME, 0, 0]
    for upper, lower in (("Анна", "анна"), ("ΑΘΗΝΑ", "αθηνα"), ("Ấn ĐỘ", "ấn độ"), ("ÜBER Ж", "über ж")):
        assert template(upper.encode()).values.tolist() == template(lower.encode()).values.tolist()
    for odd in ("İstanbul", "ẞ", "ȺȾ", "\u13a0\u1c90", "×÷"):  # small forms of other lengths, or none
        assert len(template(odd.encode())) <= 1


def test_items_with_other_names_are_caught_in_other_scripts(spark):
    item = ("в понедельник утром ученица Анна купила 12 яблок у торговца Иван а потом отдала 5 яблок подруге Мария сколько "
            "яблок осталось теперь у неё дома на столе")
    other = item.replace("Анна", "Ольга").replace("Иван", "Пётр").replace("Мария", "Дарья").replace("12", "30")
    assert set(_found(spark, [PLAIN + other, PLAIN], [item])) == {(0, 0)}
    item = ("hôm nay bạn Ấn mua 7 quyển vở ở chợ Đà rồi cho chị Ổn 3 quyển vở sau đó bạn Ấn còn lại bao nhiêu quyển vở")
    other = item.replace("Ấn", "Ánh").replace("Đà", "Mơ").replace("Ổn", "Ẩn").replace("7", "9")
    assert set(_found(spark, [PLAIN + other, PLAIN], [item])) == {(0, 0)}


def test_templates_of_several_texts_are_those_of_each():
    texts = [s.encode() for s in (
        "", "It weighs 3", "kg and Anna ran", "two hundred", "and five miles", "Bob", "1", ".5 x", "苹果", "明 Ж", "", CHANGED, SAME, ITEM, "",
    )]
    joint = templates(texts)
    for k, text in enumerate(texts):
        own = template(text)
        where = joint.owner == k
        assert where.sum() == len(own)
        for name in ("tokens", "kinds", "values", "loose", "joined"):
            assert getattr(joint, name)[where].tolist() == getattr(own, name).tolist(), (text, name)
    for size in (1, 3, 8):
        for method in ("windows", "loose_windows", "exact_windows"):
            more = () if method == "exact_windows" else (2,)
            got = getattr(joint, method)(size, *more)
            wanted, base = [], 0
            for text in texts:
                own = template(text)
                w = getattr(own, method)(size, *more)
                wanted += list(zip((w.at + base).tolist(), (w.end + base).tolist(), w.hashes.tolist(), [v.tolist() for v in w.slots],
                                   w.cuts.tolist()))
                base += len(own)
            assert list(zip(got.at.tolist(), got.end.tolist(), got.hashes.tolist(), [v.tolist() for v in got.slots],
                            got.cuts.tolist())) == wanted


def test_blocks_keep_texts_whole_and_in_order():
    texts = [b"ab", None, b"c" * 50, b"", b"d"]
    found = list(decontaminate.blocks(texts, 4))
    assert [t for b in found for t in b] == [t or b"" for t in texts]
    assert all(len(b) == 1 or sum(map(len, b)) <= 4 for b in found)
    assert list(decontaminate.blocks([], 4)) == []
