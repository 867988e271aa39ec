import re

from tests.llm.test_licenses import RULES, low
from threadloom.llm import licenses

REAL = {
    "may not be copied": "no-redistribution", "must not be reproduced": "no-redistribution", "Unauthorized copying of this file": "no-redistribution", "Unauthorised redistribution": "no-redistribution",
    "Unicode, Inc. License": "unicode", "MIT-style licence": "mit", "zlib/libpng license": "zlib",
    "SPDX-License-Identifier: MIT": "mit", "SPDX-License-Identifier: Apache-2.0": "apache-2.0", "SPDX-License-Identifier: BSD-3-Clause": "bsd-3-clause", "SPDX-License-Identifier: ISC": "isc",
    "SPDX-License-Identifier: MPL-2.0": "mpl-2.0", "SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2.0", "License: MIT": "mit", "Licensed under MIT": "mit", "Licensed under Apache 2.0": "apache-2.0",
    "Licensed under LGPL 2.1": "lgpl-2.1", "Licensed under the GPL": "gpl", "Released under BSD": "bsd", "Licensed under the MIT License": "mit",
}


def ungated(t):
    t = low(t)
    found = [(r["priority"], r["label"], m.start(), m.end()) for r in RULES for m in r["regex"].finditer(t)]
    return ",".join(sorted({d[1] for d in found if not any(h[0] < d[0] and h[2] <= d[2] and h[3] >= d[3] for h in found)}))


def test_real_examples_as_without_gate(spark):
    rows = list(REAL.items()) + [(f"{before} {k.upper()}", label) for before in ("SPDX-License-Identifier:", "License:", "released under the") for label, k, _ in licenses.IDS]
    rows += [(t, "") for t in ("submit, limit, published by MIT, runs with PostgreSQL", "under a tree", "mit")]
    got = {r["text"]: r for r in licenses.digest(licenses.scan(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string"))).collect() for r in [{"text": rows[r["doc_id"]][0], "labels": r["labels"]}]}
    for t, label in rows:
        assert got[t]["labels"] == label == ungated(t), (t, got[t]["labels"], ungated(t))


def test_each_alternative_holds_its_keyword():
    for _, keyword, signature in licenses.NAMES + licenses.IDS:
        for part in signature.split("|") if "(" not in signature else [signature]:
            plain = re.sub(r"\[sc\]", "c", part).replace("\\", "")
            bare = re.sub(r"\(\?:[^()]*\)\??", "", plain)
            assert "(" in signature or keyword in re.sub("licen.e", "licen", bare) or keyword in bare, (keyword, signature)
