import random

import numpy as np
import pytest

from parcelyard.llm import licences as lc
from tests.llm import helpers


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    return lc.train([helpers.words(rng, rng.randrange(5, 40), 3000) for _ in range(800)])


def test_held_out_accuracy(model):
    rng = random.Random(9)
    texts, labels = lc.examples([helpers.words(rng, rng.randrange(5, 40), 3000) for _ in range(300)], seed=77, variants=5)
    parts = lc._as_units(texts)
    found = lc._softmax(lc.logits(parts, model.weights) / model.temperature).argmax(1)
    answer = labels[parts.paragraph]
    known = answer < lc.UNKNOWN
    assert (found[known] == answer[known]).mean() > 0.93
    assert (found[~known] == lc.UNKNOWN).mean() > 0.98


def test_families_are_found_in_odd_rows(spark, model):
    rng = random.Random(2)
    rows = helpers.odd_rows()
    rows += [(1000 + i, f"{helpers.words(rng, 50)}\n{t}\n{helpers.words(rng, 9)}") for i, f in enumerate(lc.FAMILIES) for t in lc.TEMPLATES[f][:1]]
    rows.append((2000, helpers.words(rng, 100) + " Released under the MIT License. " + helpers.words(rng, 100)))
    rows.append((2001, "the license plate of the car was released under a bridge"))
    df = helpers.documents(spark, rows).withColumnsRenamed({"lang": "licences", "source": "family"})
    out = lc.scan_licences(df, model)
    assert out.columns == ["doc_id", "family", "n_chars", "licences"]
    got = [(r["doc_id"], [(x["paragraph"], x["family"]) for x in r["licences"]]) for r in out.collect()]
    assert len(got) == len(rows)
    found = dict(got)
    for i, family in enumerate(lc.FAMILIES):
        assert found[1000 + i] == [(1, family)], family
    assert found[2000] == [(0, "MIT")] and found[2001] == []
    assert all(not x for k, x in got if k is None or k < 1000)
    assert lc.scan_licences(helpers.documents(spark, []), model).count() == 0


NOTICES = {
    "Licensed under the GNU General Public License v2.0 or later": "GPL",
    "This file is licensed under the GNU General Public License, version 2 or any later version": "GPL",
    "Licensed under GPLv3": "GPL",
    "GNU GENERAL PUBLIC LICENSE Version 2": "GPL",
    "Licensed under the GNU Lesser General Public License v2.1 or later": "LGPL",
    "Licensed under the GNU Affero General Public License v3.0 or later": "AGPL",
    "Creative Commons Attribution-NoDerivatives 4.0": "CC-BY-ND",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.": "CC-BY-ND",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA",
    "Licensed under CC BY 4.0.": "CC-BY",
    "SPDX-License-Identifier: MIT": "MIT",
    "SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
    "# SPDX-License-Identifier: GPL-2.0-or-later": "GPL",
    "MIT License": "MIT",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted": "ISC",
    "Distributed under the Boost Software License, Version 1.0.": "BSL-1.0",
    "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY": "MIT",
    "Copyright 2019 Some House. All rights reserved.": "Proprietary",
    "I have all rights reserved seats at the opera.": None,
    " ".join(["word"] * 29) + " all rights reserved seats at the opera": None,
    "The license plate was issued by MIT students.": None,
    "the general public gave the software a free distribution": None,
}


def test_notices_of_near_families_are_told_apart(model):
    import pyarrow as pa

    texts = list(NOTICES)
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["_text"])
    rows = [r["licences"] for b in lc._scanned_batches([batch], model) for r in b.to_pylist()]
    found = {t: [x["family"] for x in r] for t, r in zip(texts, rows)}
    bad = {t: found[t] for t, f in NOTICES.items() if found[t] != ([f] if f else [])}
    assert not bad


def test_confirmation_equals_a_comparison_of_all_templates():
    rng = random.Random(6)
    stock = [w for ts in lc.TEMPLATES.values() for t in ts for w in t.split()]
    some = [t for ts in lc.TEMPLATES.values() for t in ts]

    def pairs(text):
        words = "".join(c.lower() if c.isalnum() else " " for c in text).split()
        return {(w,) for w in words} | set(zip(words, words[1:]))

    def share(have, t):
        s = len(have & pairs(t)) / len(pairs(t))
        return s if s == 1 or len(pairs(t)) > 7 else 0

    for _ in range(300):
        text = " ".join(rng.choice(some).split()[: rng.randrange(4, 30)] + rng.choices(stock, k=rng.randrange(6)))
        have, family = pairs(text), rng.choice(lc.FAMILIES)
        own = max(lc.TEMPLATES[family], key=lambda t: (share(have, t), len(have & pairs(t))))
        beaten = any(
            have & pairs(own) <= pairs(t)
            and (share(have, t), len(have & pairs(t))) > (share(have, own), len(have & pairs(own)))
            for f in lc.FAMILIES if f != family for t in lc.TEMPLATES[f]
        )
        want = 0 if beaten or share(have, own) < 0.6 else share(have, own)
        assert lc.confirmed(text, family) == want, (text, family)


def test_batches_equal_texts_one_by_one(model):
    import pyarrow as pa

    rng = random.Random(5)
    stock = [t for f in lc.TEMPLATES.values() for t in f]
    texts = ["\n".join(rng.choice([*stock, "", helpers.words(rng, rng.randrange(80))]) for _ in range(6)) for _ in range(40)]
    scan = lambda some: [r["licences"] for b in lc._scanned_batches([pa.RecordBatch.from_arrays([pa.array(some)], ["_text"])], model) for r in b.to_pylist()]
    one_by_one = [scan([t])[0] for t in texts]
    for a, b in zip(scan(texts), one_by_one):
        assert [(x["paragraph"], x["family"]) for x in a] == [(x["paragraph"], x["family"]) for x in b]
        assert np.allclose([x["probability"] for x in a], [x["probability"] for x in b], atol=1e-4)


def test_a_line_in_many_documents_takes_one_place_in_the_sample(spark):
    footers = [f"footer {i} of the house" for i in range(40)]
    rows = [(k, "\n".join([f"line {k} alone", *footers])) for k in range(3000)]
    found = lc.sample_paragraphs(helpers.documents(spark, rows).repartition(16), most=500)
    assert len(found) == len(set(found)) == 500
    assert sum(line.startswith("footer") for line in found) < 40
    every = lc.sample_paragraphs(helpers.documents(spark, rows), most=5000)
    assert sorted(every) == sorted({*footers, *(f"line {k} alone" for k in range(3000))})
    assert every[:500] == found


def test_sample_and_training_without_corpus(spark):
    rows = helpers.odd_rows()
    found = lc.sample_paragraphs(helpers.documents(spark, rows), most=10)
    assert len(found) == 10 and all(0 < len(p.split()) <= lc.UNIT for p in found)
    assert lc.sample_paragraphs(helpers.documents(spark, [])) == []
    assert lc.train([]).temperature > 0


def test_wrapped_headers_are_found(model):
    import textwrap

    import pyarrow as pa

    scan = lambda some: [r["licences"] for b in lc._scanned_batches([pa.RecordBatch.from_arrays([pa.array(some)], ["_text"])], model) for r in b.to_pylist()]
    rng = random.Random(3)
    texts, wants = [], []
    for family in ("MIT", "Apache-2.0", "GPL", "LGPL", "AGPL", "BSD"):
        long = max(lc.TEMPLATES[family], key=len)
        for width in (40, 70, 80):
            for sign in ("", "# ", " * ", "// "):
                body = [sign + x for x in textwrap.wrap(long, width)]
                assert len(body) > 1
                texts.append("\n".join([helpers.words(rng, 12, 3000), sign.rstrip(), *body, sign.rstrip(), helpers.words(rng, 12, 3000)]))
                wants.append([(2, family)])
    texts.append("\n\n".join(textwrap.wrap(lc.TEMPLATES["BSD"][1], 30)))
    wants.append([])
    got = [[(x["paragraph"], x["family"]) for x in found] for found in scan(texts)]
    bad = [(t, w, g) for t, w, g in zip(texts, wants, got) if [f for _, f in w] != sorted({f for _, f in g})]
    assert not bad, (len(bad), len(texts), bad[:4])
    assert sum(w == g for w, g in zip(wants, got)) > 0.6 * len(texts)
