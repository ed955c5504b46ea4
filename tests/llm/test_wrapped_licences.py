"""Notices wrapped over several lines."""

import inspect

from maillage.llm import licenses

NOTICES = {
    "BSD": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.",
    "Unlicense": "This is free and unencumbered\nsoftware released into\nthe public domain.",
}
MARKS = ["", " * ", "# ", "// ", "-- "]


def test_wrapped_notices(docs):
    rows, want = [], {}
    for k, (family, notice) in enumerate(NOTICES.items()):
        for m, mark in enumerate(MARKS):
            key = 100 + 10 * k + m
            lines = ["Some tool for tables", mark.rstrip(), *(mark + x for x in notice.split("\n")), mark.rstrip(), "and the words that come after"]
            rows.append((key, "\n".join(lines)))
            want[key] = [(2, family)]
    rows.append((300, "Some words\n" + NOTICES["BSD"] + "\nmore words\n" + NOTICES["ISC"]))  # no blank line between
    want[300] = [(1, "BSD"), (4, "ISC")]
    rows.append((301, NOTICES["BSD"].replace("\n", "\n\n\n")))  # apart: no notice
    want[301] = []
    plain = [(1000 + i, f"some words here {i}\nand the others under that {i}\npermission to use the library") for i in range(40)]
    table = docs([*rows, *plain])
    got = {r.doc_id: [(f.paragraph, f.family) for f in r.found] for r in licenses.scanned(table, licenses.train(table)).collect()}
    assert {k: got[k] for k in want} == want
    assert not any(got[k] for k, _ in plain)


def test_bounds_are_settings():
    for name in ("sample_documents", "sample_lines", "plain_lines", "line_words", "filler_lines", "filler_words"):
        assert hasattr(licenses.Setting(), name) and f"`{name}`" in licenses.__doc__
    assert "6000" not in inspect.getsource(licenses.fit)
