import random
import re

from llm_samples import LONG, docs  # noqa: F401

from siltframe.llm import decontam

ITEM = "A train leaves the station at 9:30 with 120 passengers and Anna counts 45 km until the next stop near the river"


def test_leaks_with_and_without_other_values(docs, frame):
    items = frame("item_id long, text string, doc_id string", (1, ITEM, "x"), (2, "short one", "x"), (3, "", "x"), (4, None, "x"), (None, ITEM, "x"), (5, "quite another text about the growth of trees in cold places", "x"))
    changed = ITEM.replace("9:30", "7:15").replace("120", "80").replace("Anna", "Peter").replace("45 km", "30 miles")
    texts = [
        None, "", f"Before it. {ITEM} and so on", changed, "A train is late", "A train leaves the station with people",
        "short one", "this is a short one", LONG, f"{LONG} {ITEM} {LONG}", ITEM.replace("station", "harbour").replace("passengers", "sailors"),
        "Trees grow in cold places where another text about growth is quite rare",
    ]
    got = {(r["doc_id"], r["item_id"]): (r["containment"], r["changed"]) for r in decontam.leaks(docs(*texts), items).collect()}
    assert set(got) == {(2, 1), (3, 1), (6, 2), (9, 1)}
    assert got[3, 1][1] and not got[2, 1][1] and got[2, 1][0] >= 0.8
    assert decontam.leaks(docs(), items).count() == 0 == decontam.leaks(docs(*texts), items.limit(0)).count()


def test_slots_must_be_consistent(docs, frame):
    text = "on the road {0} met old friends from home and then {1} told them of the {2} days and the {2} nights at sea"
    items = frame("item_id long, text string", (1, text.format("Anna", "Anna", 7)))
    same, torn = text.format("Peter", "Peter", 9), text.format("Peter", "Maria", 9)
    assert [r["doc_id"] for r in decontam.leaks(docs(same, torn), items).collect()] == [0]


def test_null_and_repeated_ids_are_one_document(docs, frame):
    items = frame("item_id long, text string", (1, ITEM), (1, ITEM))
    got = decontam.leaks(docs(ITEM, ITEM, "clean text", ITEM, ids=[4, 4, 5, None]), items).collect()
    assert sorted(r["doc_id"] or 0 for r in got) == [0, 4]


def test_names_at_the_start_of_sentences_are_slots(docs, frame):
    text = "{0} has 5 red apples. {0} buys 3 more apples. {1} then eats 2 of them. How many apples does {0} have now?"
    quoted = "\"{0} went to the old market\"\n{0} bought a loaf of bread (which {0} then ate at home)"
    items = frame("item_id long, text string", (1, text.format("Tom", "Tom")), (2, quoted.format("Tom")))
    texts = [text.format("Tom", "Tom"), text.format("Anna", "Anna"), text.format("Anna", "Maria"), quoted.format("Anna"), "so " + quoted.format("Tom").lower()]
    got = {(r["doc_id"], r["item_id"]): r["changed"] for r in decontam.leaks(docs(*texts), items).collect()}
    assert got == {(0, 1): False, (1, 1): True, (3, 2): True}


def test_a_name_of_several_words_is_one_slot(docs, frame):
    text = "{0} has 5 red apples. Later {0} buys 3 more apples, and {1} then eats 2 of them. How many apples does {0} have now?"
    items = frame("item_id long, text string", (1, text.format("Tom Smith", "Bob Jones")))
    texts = [text.format(*names) for names in (("Tom Smith", "Bob Jones"), ("Anna", "Carl"), ("Anna Maria Lopez", "Carl"), ("Anna", "Anna"))]
    torn = text.format("Anna", "Carl").replace("does Anna", "does Lisa").replace("Later Anna", "Later Rosa")
    got = {(r["doc_id"], r["item_id"]): r["changed"] for r in decontam.leaks(docs(*texts, torn), items).collect()}
    assert got == {(0, 1): False, (1, 1): True, (2, 1): True, (3, 1): True}


def test_short_items_inside_longer_texts(docs, frame):
    items = frame("item_id long, text string", (1, "What is love?"), (2, "short one"), (3, "Count 7 red apples"), (4, "42"))
    texts = ["He asked: what is love, and went", "what is a love", "a short one here", "Count 7 red apples now please do", "Count 8 red apples now please do", "short one", "17", "42 17 42"]
    got = {(r["doc_id"], r["item_id"]): r["changed"] for r in decontam.leaks(docs(*texts), items).collect()}
    assert got == {(0, 1): False, (3, 3): False, (5, 2): False, (6, 4): True}


def test_texts_without_an_id_are_judged_one_by_one(docs, frame):
    items = frame("item_id long, text string", (1, ITEM))
    words = ITEM.split()
    halves = " ".join(words[:13]), " ".join(words[9:])
    assert decontam.leaks(docs(*halves, *halves, ids=[None, None, 3, 3]), items).count() == 0
    got = decontam.leaks(docs(*halves, ITEM, ITEM, halves[0], ids=[None, None, None, 3, 3]), items).collect()
    assert sorted(r["doc_id"] or 0 for r in got) == [0, 3]


def test_runs_of_numbers_and_names_bring_no_pairs(docs, frame, spark):
    numbers = " ".join(str(i) for i in range(40))
    items = frame("item_id long, text string", *[(i, f"question about thing{i} and its kind{i} whose part{i} has " + numbers + " " + " ".join(f"w{i}x{j}" for j in range(25))) for i in range(20)])
    texts = [" ".join(str(i) for i in range(4000)), ",".join("12345"), ",".join(str(i) for i in range(50_000)), "Word " * 50_000]
    own = decontam.windows(decontam.forms(items.selectExpr("item_id", "item_id as unit", "text"), ["item_id", "unit"]), ["item_id", "unit"])
    rows = docs(*texts).selectExpr("doc_id", "xxhash64(text) as mark", "text")
    assert decontam._likely(rows, own, 0.8, 5).count() == 0 == decontam.leaks(docs(*texts), items).count()


def _brute(text, form):
    """Signs and values word by word, by the rules and not by their patterns."""
    signs, values, left = [], [], None
    for sentence_word in re.findall(r"\S+", text):
        word = re.sub(r"[^\w]|_", "", sentence_word)
        before, left = left, sentence_word
        if re.fullmatch(r"\d+", word):
            signs.append("§n")
        elif signs and signs[-1] == "§n" and before[-1].isdigit() and word.lower() in decontam.UNITS.split():
            signs.append("§u")
        elif re.match(r"[A-Z][a-z]+$", word) and sentence_word[0].isupper() and (form or (before and (before[-1].islower() or before[-1].isdigit() or before[-1] in ",;"))):
            if signs and signs[-1] == "§p" and before[-1].islower():
                values[-1].append(word.lower())
                continue
            signs.append("§p")
        else:
            signs.append(word.lower())
        values.append([word.lower()])
    return signs, ["".join(v) for v in values]


def test_signs_and_values_against_a_rule_by_rule_version(frame):
    draw = random.Random(7)
    vocabulary = ["Tom", "Anna", "Smith", "Miles", "km", "Hours", "walks", "on", "the", "old", "7", "45", "120"]
    texts = [" ".join(draw.choice(vocabulary) + draw.choice(["", "", "", ",", ".", "?"]) for _ in range(draw.randint(1, 30))) for _ in range(300)]
    rows = frame("doc_id long, text string", *enumerate(texts))
    value = lambda sign, v: v[1:-1] if sign in ("§n", "§u") else v.replace("§", "")
    got = {
        (r["doc_id"], r["form"]): (r["words"], [value(*pair) for pair in zip(r["words"], r["values"], strict=True)])
        for r in decontam.forms(rows, ["doc_id"], values=True).collect()
    }
    for (doc, form), (signs, values) in got.items():
        assert (signs, values) == _brute(texts[doc], form), texts[doc]


def _held(item, text, width=5):
    """Every window of every alignment, by loops: does ``text`` hold ``item`` in either form?"""
    for form in decontam.FORMS:
        (mine, own), (theirs, values) = _brute(item, form), _brute(text, form)
        found = set()
        for shift in range(1 - len(mine), len(theirs)):
            places = [p for p in range(len(mine) - width + 1) if 0 <= p + shift <= len(theirs) - width and mine[p : p + width] == theirs[p + shift : p + shift + width]]
            slots = {p + k for p in places for k in range(width) if mine[p + k].startswith("§")}
            met = {}
            for s in slots:
                met.setdefault(own[s], set()).add(values[s + shift])
            if all(len(v) == 1 for v in met.values()):
                found |= set(places)
        if len(mine) >= width and len(found) >= 0.8 * (len(mine) - width + 1):
            return True
    return False


def test_leaks_against_all_alignments(docs, frame):
    draw = random.Random(11)
    plain = ["walks", "on", "the", "old", "road", "sees", "red", "birds"]
    names = ["Tom", "Anna", "Bob Jones", "Eva Maria Lopez"]

    def template():
        return [draw.choice([*plain, "{0}", "{1}", "{2}", "{2} km"]) for _ in range(draw.randint(8, 30))]

    def filled(parts):
        one, two = draw.sample(names, 2)
        return " ".join(parts).format(one, two, draw.randint(1, 99))

    templates = [template() for _ in range(25)]
    items = [filled(t) for t in templates]
    texts = []
    for parts in templates * 4:
        parts = list(parts)
        for _ in range(draw.choice([0, 0, 1, 1, 3])):
            parts[draw.randrange(len(parts))] = draw.choice(plain)
        body = filled(parts) if draw.random() < 0.8 else " ".join(p.format(*draw.sample(names, 2), draw.randint(1, 99)) for p in parts)
        texts.append(f"{filled(template())}, {body} {filled(template())}")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(docs(*texts), frame("item_id long, text string", *enumerate(items))).collect()}
    want = {(d, i) for d, text in enumerate(texts) for i, item in enumerate(items) if _held(item, text)}
    assert got == want and 25 < len(want) < 95
