import re

from llm_samples import LONG, docs  # noqa: F401

from siltframe.llm import licenses as lic

TEXTS = [
    None, "", "...", "Licensed under CC BY-NC 4.0.", "cc\n\nBY. all  rights, RESERVED; General Public Licenseé General public license",
    "acc by cc bye ccé by", "Released under the MIT License.", "released under the mit", "Licensed under the Apache License, Version 2.0. More text.",
    "CC BY CC BY", LONG + " all rights reserved " + LONG, "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under the Apache\nLicense, Version 2.0", "license " * 50,
    "Redistribution and use in source and binary forms, with or without\r\n * modification, are permitted provided that",
    "Licensed under the Apache License 2.0 and released under the MIT License", "Licensed under CC\n\nBY-NC 4.0 and more",
    "Released under the\n \t\nMIT License", "Licensed under CC BY 4.0, released!\n\n\nunder the MIT License? Released\nunder the MIT\nLicense",
]
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text):
    own, places, base = words(text), [], set()
    for phrase, label in lic.PHRASES.items():
        parts = phrase.split()
        found = [i for i in range(len(own)) if own[i : i + len(parts)] == parts]
        places += found
        base |= {label} if found else set()
    labels, score = set(base), 0.0
    for block in re.split(r"(?<=[.!?])[ \t\r\n]+|\n[ \t\r]*\n", text or ""):
        own_set, held = set(words(block)), []
        for label, template in lic.TEMPLATES:
            tokens = set(words(template))
            held.append((len(own_set & tokens) / len(tokens), own_set & tokens, label))
        held = [x for x in held if x[0] >= lic.THRESHOLD]
        labels |= {x[2] for x in held if not any(x[1] <= y[1] and (y[0], len(y[1])) > (x[0], len(x[1])) for y in held)}
        score = max([score, *(x[0] for x in held)])
    first_last = (min(places), max(places)) if places else (None, None)
    return (len(own), len(places), *first_last, ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if places else score)


def test_phrases_and_templates_equal_brute_force(docs):
    got = lic.scanned(docs(*TEXTS)).orderBy("doc_id").collect()
    for row, text in zip(got, TEXTS, strict=True):
        assert tuple(row)[1:] == brute(text), text
    assert lic.scanned(docs()).count() == 0


def test_repeated_and_null_ids(docs):
    got = lic.scanned(docs("cc by", "cc by", "mit", ids=[1, 1, None])).collect()
    assert sorted((r["doc_id"] or 0, r["base_labels"]) for r in got) == [(0, ""), (1, "cc-by"), (1, "cc-by")]


def test_wrapped_and_several_licences(docs):
    got = {r["doc_id"]: r["labels"] for r in lic.scanned(docs(*TEXTS)).collect()}
    label = {text: got[i] for i, text in enumerate(TEXTS)}
    assert label["Licensed under the Apache\nLicense, Version 2.0"] == "apache"
    assert [v for k, v in label.items() if k and k.startswith("Redistribution")] == ["bsd"]
    assert label["Licensed under the Apache License 2.0 and released under the MIT License"] == "apache,mit"
    assert label["Licensed under CC BY-NC 4.0."] == "cc-by,cc-by-nc" and label["Released under the\n \t\nMIT License"] == ""


def test_sql_agrees_with_the_operator_on_odd_texts(docs):
    import duckdb

    from siltframe.llm.queries import ORACLES

    documents = docs(*TEXTS).select("doc_id", "text").toPandas()
    base = duckdb.connect()
    base.register("documents", documents)
    rows = base.execute(ORACLES["op4_licenses"] + " order by doc_id").fetchall()
    assert rows == [tuple(r) for r in lic.scanned(docs(*TEXTS)).orderBy("doc_id").collect()]
