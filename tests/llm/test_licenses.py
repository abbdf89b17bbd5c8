"""License labels: base phrases against brute force, and the rules' order."""

import random
import re

from corvane.llm import licenses

SF = "/root/testdata/sf0.01"


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = []
    for phrase, label in licenses.BASE.items():
        own = phrase.split()
        found += [(k, label) for k in range(len(words)) if words[k : k + len(own)] == own]
    places = [k for k, _ in found]
    return len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))


def labels(text):
    return {r.label for *_, r in licenses.detections(text.encode().lower())}


def test_base_on_given_and_made_texts(spark):
    rng = random.Random(1)
    bits = ["GNU", "general", "public", "License", "apache", "mit", "CC", "by", "cc-by", "É", "x9", ";", "_", "licenses", "mit license"]
    made = [rng.choice(["", " ", "-", "\n"]).join(rng.choices(bits, k=rng.randint(0, 20))) for _ in range(300)]
    made += ["".join(rng.choice([" ", "/", "ß", ""]) + b for b in rng.choices(bits, k=12)) for _ in range(100)]
    rows = [*enumerate([*made, "", None])]
    given = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = spark.createDataFrame([(k + 10**6, t) for k, t in rows], "doc_id long, text string").union(given)
    texts = dict(docs.collect())
    got = licenses.scan(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_rules():
    assert len(licenses.rules()) > 300
    assert labels("under the GNU General Public License, version 2 or later.") == {"gpl-2.0"}
    assert labels("GNU Lesser General Public License v2.1") == {"lgpl-2.1"}
    assert labels("SPDX-License-Identifier: Apache-2.0") == {"apache-2.0"}
    assert labels("licensed under the MIT License") == {"mit"}
    assert labels("CC BY-NC-SA 4.0") == {"cc-by-nc-sa-4.0"}
    assert labels("a 2-clause BSD license; Creative Commons Attribution-NonCommercial ShareAlike 3.0") == {"bsd-2-clause", "cc-by-nc-sa-3.0"}
    assert labels("CC-BY 4.0 and the Apache License 2.0") == {"cc-by-4.0", "apache-2.0"}
    assert labels("Permission is hereby granted, free of charge,\nto any person obtaining a copy") == {"mit"}
    assert labels("nothing of this permits smitten gplx") == set()


def test_suppression_is_by_containment():
    rng = random.Random(2)
    pool = [licenses.Rule(f"r{p}{k}", (), re.compile(b""), p, 0.5) for p in (1, 2, 3) for k in range(2)]
    for _ in range(300):
        found = []
        for _ in range(rng.randint(0, 12)):
            a = rng.randint(0, 20)
            found.append((a, a + rng.randint(1, 8), rng.choice(pool)))
        kept = []
        for x in sorted(found, key=lambda x: (-x[2].priority, x[0] - x[1], x[0], x[2].label)):
            if not any(k[0] <= x[0] and x[1] <= k[1] for k in kept):
                kept.append(x)
        assert licenses.suppressed(found) == sorted(kept, key=lambda x: (x[0], x[1], x[2].label))


def test_nothing(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []
