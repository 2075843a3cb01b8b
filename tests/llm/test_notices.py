"""Wrapped licence notices, and notices of other licences."""

from rillhouse.llm import licenses

MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy\n"
       "of this software and associated documentation files (the \"Software\"), to deal\nin it")
NOTICES = {
    MIT: "mit", "# " + MIT.replace("\n", "\n# "): "mit",
    "x y z\nThis work is licensed under the GNU\nGeneral Public License, version 3.": "gpl-3",
    "Released under the BSD License.": "",
    "Licensed under the Mozilla Public License, Version 2.0": "",
    "Licensed under CC BY-SA 4.0": "",
    "This work is licensed under the GNU Lesser General Public License, version 3.": "",
    "This work is licensed under the GNU General Public License, version 2.": "",
    "released a b c d e f g h under i j k l m n o the p q r s t u mit license": "",
}


def test_wrapped_and_other_notices(spark):
    rows = spark.createDataFrame(list(enumerate(NOTICES)), "doc_id bigint, text string")
    found = {r.doc_id: r.labels for r in licenses.scan(rows).collect()}
    assert found == dict(enumerate(NOTICES.values()))
