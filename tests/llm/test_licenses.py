import random
from collections import Counter

import brute
from conftest import bag, texts_of

from lakeops.llm import licenses


def plain(text, templates):
    words = brute.WORD.findall(brute.lower(text))
    places, base = [], set()
    for phrase, label in licenses.PHRASES.items():
        own = phrase.split()
        hits = [i for i in range(len(words)) if words[i : i + len(own)] == own]
        places += hits
        base |= {label} if hits else set()
    found = {}
    for label, template in templates.items():
        every, needs, bars = (brute.WORD.findall(brute.lower(x)) for x in (template.text, template.needs, template.bars))
        own, size = set(every), len(every) + len(every) // 4
        for i in range(len(words)):
            have = set(words[i : i + size])
            enough = 100 * len(own & have) >= round(100 * licenses.THRESHOLD) * len(own)
            if words[i] in own and enough and have.issuperset(needs) and not have.intersection(bars):
                found[label] = max(found.get(label, 0), len(own & have) / len(own))
    return (
        len(words), len(places), min(places, default=None), max(places, default=None),
        ",".join(sorted(base)), ",".join(sorted(base | set(found))),
        1.0 if base else max(found.values(), default=0.0),
    )


def test_as_found_plainly(documents, awkward):
    for df in (documents, awkward):
        expected = brute.ordered((d, *plain(t, licenses.TEMPLATES)) for d, t in texts_of(df))
        assert bag(licenses.scan(df)) == expected


def test_random_blocks_and_templates(spark):
    draw = random.Random(4)
    vocabulary = [f"w{i}" for i in range(14)]
    templates = {}
    for i in range(12):
        own = draw.choices(vocabulary, k=draw.randint(1, 9))
        needs, bars = own[: draw.randint(0, 1)], draw.sample(vocabulary, draw.randint(0, 1))
        templates[f"t{i}"] = licenses.Template(" ".join(own), " ".join(needs), " ".join(bars))
    texts = [
        "\n".join(" ".join(draw.choices(vocabulary, k=draw.randint(0, 12))) for _ in range(draw.randint(0, 5)))
        for _ in range(300)
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = brute.ordered((d, *plain(t, templates)) for d, t in enumerate(texts))
    assert bag(licenses.scan(df, templates)) == expected


def test_empty_table(no_documents):
    assert licenses.scan(no_documents).count() == 0


def labels(text, frequency=None):
    words = licenses.words(text.encode())
    return sorted(licenses.Matcher(licenses.TEMPLATES, frequency or {}).labels(words))


def test_licenses_are_told_apart():
    assert labels("Licensed under CC BY 4.0.") == ["cc-by-4.0"]
    assert labels("Licensed under CC BY-NC 4.0.") == ["cc-by-nc-4.0"]
    assert labels("Licensed under CC BY-SA 4.0.") == ["cc-by-sa-4.0"]
    assert labels("Licensed under CC BY-NC-SA 4.0.") == ["cc-by-nc-sa-4.0"]
    assert labels("Released under the Apache License") == ["apache"]
    assert labels("Released under the BSD License") == ["bsd"]
    assert labels("Released under the MIT License.") == ["mit"]
    first = "Permission is hereby granted, free of charge, to any person obtaining a copy"
    assert labels(first) == ["mit-offer"]
    assert labels("GNU Lesser General Public License") == ["lgpl"]
    assert labels("nothing of the kind is said in this text") == []


def test_notices_that_wrap_over_lines():
    for label, template in licenses.TEMPLATES.items():
        own = template.text.split()
        wrapped = "\n".join(" ".join(own[i : i + 4]) for i in range(0, len(own), 4))
        assert label in labels(f"Some words before it.\n{wrapped}\nand some after it.")


def test_each_filter_takes_candidates_away(documents):
    """Counts over the given documents and an order by their words."""
    texts = [licenses.words((t or "").encode()) for _, t in texts_of(documents)]
    frequency = Counter(w for t in texts for w in t)
    matcher = licenses.Matcher(licenses.TEMPLATES, frequency)
    starts = 0
    for t in texts:
        matcher.labels(t)
        starts += sum(w in own for own, *_ in matcher.templates.values() for w in t)
    passed = matcher.passed
    assert starts > passed["prefix"] > passed["length"] > passed["position"] > passed["all"] > 0
