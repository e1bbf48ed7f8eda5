"""Licence notices as documents hold them: wrapped and inside long lines."""

import textwrap

from plenaria.llm import licenses

MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use"
ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
GPL = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"


def scan(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [(r.license, r.n_diff) for r in licenses.scan(docs).orderBy("doc_id").collect()]


def test_wrapped_notices(spark):
    wrapped = ["\n".join(textwrap.wrap(t, 60, initial_indent=x, subsequent_indent=x)) for t, x in ((MIT, ""), (ISC, ""), (GPL, "# "), (BSD, " * "))]
    got = scan(spark, wrapped)
    assert [x for x, _ in got[:3]] == ["MIT", "ISC", "GPL-3.0"] and got[3][0].startswith("BSD")
    assert licenses.blocks(b"a licence\nof two lines\n\nnone here") == ["a licence of two lines"]


def test_notices_inside_long_lines(spark):
    prose = "the quiet harbour kept its boats through winter and nobody wrote down why it did so "
    texts = [prose * n + t + " " + prose * n for n in (1, 3, 20, 200) for t in ("Released under the MIT License.", BSD)]
    got = scan(spark, [*texts, prose * 9 + "a driving licence, with permission, is asked for"])
    assert [x and x[:3] for x, _ in got] == ["MIT", "BSD"] * 4 + [None]
    two = "Released under the MIT License. " + prose + "Licensed under the Apache License, Version 2.0."
    docs = spark.createDataFrame([(0, two)], "doc_id long, text string")
    assert licenses.scan(docs).first().licenses == ["Apache-2.0", "MIT"]


def test_neighbouring_licences_are_told_apart(spark):
    two = BSD + "\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
    end = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING"
    three = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\n"
    cc = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."
    texts = {
        GPL: "GPL-3.0",
        GPL.replace("GNU General", "GNU Lesser General"): "LGPL-3.0",
        GPL.replace("GNU General", "GNU Affero General"): "AGPL-3.0",
        GPL.replace("version 3", "version 2"): "GPL-2.0",
        GPL.replace("version 3", "version 7"): None,
        cc.format("-NonCommercial-NoDerivatives"): "CC-BY-NC-ND-4.0",
        cc.format("-NonCommercial"): "CC-BY-NC-4.0",
        "Licensed under CC BY-NC-ND 4.0.": "CC-BY-NC-ND-4.0",
        two + end: "BSD-2-Clause",
        two + three + end: "BSD-3-Clause",
        BSD: "BSD",
    }
    assert scan(spark, list(texts)) == [(x, x and 0) for x in texts.values()]
    assert scan(spark, [GPL.replace("redistribute it", "freely redistribute it")]) == [("GPL-3.0", 1)]


def edits(words, spoken):
    """The fewest edits from words to a stretch of spoken, and the changed words of one such alignment."""
    import re

    cost = [[(j * 0, []) for j in range(len(spoken) + 1)]]
    for i, w in enumerate(words, 1):
        row = [(i, [*cost[-1][0][1], w])]
        for j, x in enumerate(spoken, 1):
            kept = cost[-1][j - 1] if w == x else (cost[-1][j - 1][0] + 1, [*cost[-1][j - 1][1], w, x])
            row.append(min(kept, (cost[-1][j][0] + 1, [*cost[-1][j][1], w]), (row[-1][0] + 1, [*row[-1][1], x]), key=lambda c: c[0]))
        cost.append(row)
    n, changed = min(cost[-1], key=lambda c: c[0])
    return n, any(re.search(licenses.MARKS, w) for w in changed)


def test_compression_loses_no_notice_that_wording_confirms(spark):
    """Against every template aligned with every whole text."""
    import random

    r = random.Random(3)
    prose = "the quiet harbour kept its boats through winter and nobody wrote down why it did so".split()
    names = {t: n for n, texts in licenses.TEMPLATES.items() for t in texts}
    planted, texts = [], []
    for t, n in names.items():
        words = t.split()
        for k in range(len(words) // 14):  # within a tenth of the words, and no word that tells licences apart
            at = r.randrange(1, len(words))
            if not licenses.MARKS.search(words[at].lower()) and licenses.TOKEN.fullmatch(words[at]):
                words[at] = "changed" + "abcdefghij"[k] if r.random() < 0.6 else words[at] + " added"
        planted.append(n)
        texts.append(" ".join(r.choices(prose, k=r.randrange(60))) + ". " + " ".join(words) + " " + " ".join(r.choices(prose, k=r.randrange(60))))
    texts += [" ".join(r.choices(prose, k=200)), "a licence to keep boats, by permission of the harbour, and its copyright", "You may not use this file", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: set(x.licenses) for x in licenses.scan(docs).collect()}
    for i, text in enumerate(texts):
        said = [m.group().lower() for m in licenses.TOKEN.finditer(text)]
        fits = set()
        for t, n in names.items():
            words = licenses.TOKEN.findall(t.lower())
            if len(set(words) & set(said)) >= 0.6 * len(set(words)):
                off, marked = edits(words, said)
                if off <= 0.1 * len(words) + 1e-9 and not marked:
                    fits.add(n)
        assert got[i] <= fits and bool(got[i]) == bool(fits), (text, got[i], fits)
        assert i >= len(planted) or planted[i] in got[i], (text, got[i])
