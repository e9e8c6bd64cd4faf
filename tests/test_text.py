import re

import pytest
from frames import column
from pyspark.sql import functions as F

from headingflow.functions.text import (
    BOILERPLATE,
    HINTS,
    MINISTER_HINTS,
    clean_question,
    model_input,
    normalise_spaces,
    word_count,
)


#: Questions, and what must be left of them.
EDGE_TEXTS = [
    ('12. Deputy Seán Ó Sé asked the Minister for Health, if he will make a statement on the matter.', 'the minister for health'),
    ('asked the Minister for Health what he plans to do', ''),
    ('asked the Minister for Enterprise, Trade and Employment, to outline the plan', 'trade and employment the plan'),
    ('Deputy O’Brien asked the Minister for Justice, the reason', 'deputy o brien the reason'),
    ('asked the Minister of State at the Department of Health, and if so, why', 'why'),
    ('the costs, and if he will make a statement on the matter', 'the costs and'),
    ('whether she will make a statement on the matter; in relation to COVID-19 and 2025', 'covid-19 and 2025'),
    ('the Tánaiste and the Taoiseach, étánaiste taoiseachs', 'and étánaiste taoiseachs'),
    ('İstanbul in relation to ½ ² snake_case - dash', 'i stanbul ½ ² snake_case - dash'),
    ('and\xa0if\u2003so and if\tnot', ''),
    ('the miniſter aſked the minister for health, yes', 'the miniſter yes'),
    ('asked the miniſter for health, yes', 'yes'),
    ('asked the mınister for health, yes', 'yes'),
    ('and ıf so', ''),
    ('  to outline  ', ''),
    ('If he will make a statement on the matter', ''),
    ('', ''),
    (None, ''),
    ('NFD: Seán Óg, Tánaiste', 'nfd sea n óg ta naiste'),
    ('1. 2. 3.', '2 3'),
    ('日本 の 質問、 то outline', '日本 の 質問 то outline'),
]

#: Fragments of boilerplate, marks and odd spaces in any order.
MIXED_TEXTS = [
    ('cost of details   \u2003 \u2014 asked the Minister for Health to outline  ', 'cost of details'),
    ('. to provide  detailsif he will make a statement on the matterthe', 'to provide detailsif he will make a statement on the matterthe'),
    ('_and if she will make a statement', '_and if she will make a statement'),
    ("Deputy Ann O'Neill askedcost of detailsDeputy Ann O'Neill asked́. asked the Minister for Healthx_yTánaiste", 'deputy ann o neill askedcost of detailsdeputy ann o neill asked'),
    ('x_yand the', 'x_yand the'),
    (' é x_y', 'é x_y'),
    ("so Deputy Ann O'Neill asked", 'so deputy ann o neill asked'),
    ('asked the Minister of State at Cultureif́asked the Minister for Healthéso', ''),
    ('estate to provide  details if to provide  details _ asked the Minister of State at Culture whether she will make a statement on the matter', 'estate if _'),
    ('Beta-2asked the Minister for Healthcost of detailsso7.asked the Minister for Healthasked the Minister of State at Culture', 'beta-2asked the minister for healthcost of detailsso7'),
    ('. if he will make a statement on the matterestateto outlinein relation\nto', 'if he will make a statement on the matterestateto outlinein relation to'),
    ('.  \u2003 cost of details Beta-2 asked the Minister of State at Culture   , so \u0301', 'cost of details beta-2 so'),
    ('and_,éifcost of detailś', 'and_ éifcost of details'),
    ("Deputy Ann O'Neill asked asked the Minister of State at Culture whether she will make a statement on the matter the and if she will make a statement if he will make a statement on the matter 7. estate to outline", 'the minister of state at culture the 7 estate'),
    ('asked the Minister of State at Culture — asked the Minister for Health to provide  details', ''),
    ('whether she will make a statement on the matterthe. x_y', 'whether she will make a statement on the matterthe x_y'),
    ('the Taoiseach not asked the Minister of State at Culture', 'not'),
    ("Deputy Ann O'Neill asked \u2014 \u0301 the Taoiseach in relation\nto  ", ''),
    ('and to provide  details \u2014 .  estate in relation\nto the Taoiseach   x_y', 'and estate x_y'),
    ('to provide  detailsin relation\ntothe', 'to provide detailsin relation tothe'),
    ('cost of details cost of details é', 'cost of details cost of details é'),
    ('so_andto provide  detailscost of detailsé', 'so_andto provide detailscost of detailsé'),
    ('\x1c 7. asked the Minister for Health the if he will make a statement on the matter \xe9 to outline', ''),
    ('and so   and if she will make a statement — the Taoiseach x_y', 'and so x_y'),
    ("  in relation\nto in relation\nto Deputy Ann O'Neill asked Beta-2   to provide  details", 'deputy ann o neill asked beta-2'),
    ('the Taoiseachcost of details7.\x1cand if she will make a statement\u0301cost of details\x1c', 'the taoiseachcost of details7 cost of details'),
    ("Deputy Ann O'Neill askedto outline\x1cT\xe1naiste\xe9", 'deputy ann o neill askedto outline tánaisteé'),
    ("whether she will make a statement on the matterDeputy Ann O'Neill askedx_y. whether she will make a statement on the matterto provide  detailstheand if she will make a statementso", 'whether she will make a statement on the matterdeputy ann o neill askedx_y whether she will make a statement on the matterto provide detailstheand if she will make a statementso'),
    ('if he will make a statement on the matter—asked the Minister for Healthand if she will make a statementand', ''),
    ('é the  ', 'é the'),
    ('and in relation\nto  ', 'and'),
    ("estate and if she will make a statement estate \x1c not Deputy Ann O'Neill asked 7.", 'estate estate not deputy ann o neill asked 7'),
    ('whether she will make a statement on the matter ́ so x_y asked the Minister for Health', 'so x_y'),
    ("théDeputy Ann O'Neill asked́x_ynotand if she will make a statement", 'the deputy ann o neill asked x_ynotand if she will make a statement'),
    ('andwhether she will make a statement on the matternot —7.if he will make a statement on the matterwhether she will make a statement on the matterto provide  details', 'andwhether she will make a statement on the matternot 7 if he will make a statement on the matterwhether she will make a statement on the matterto provide details'),
    ('if whether she will make a statement on the matter', 'if'),
    ("Deputy Ann O'Neill asked asked the Minister for Health \x1c   if he will make a statement on the matter asked the Minister of State at Culture", 'the minister of state at culture'),
    ("asked the Minister for Healthin relation\ntoand cost of detailsif he will make a statement on the matterandDeputy Ann O'Neill asked", ''),
    ('to provide  details whether she will make a statement on the matter in relation\nto Beta-2 x_y x_y', 'beta-2 x_y x_y'),
    ('ifthesoand', 'ifthesoand'),
]


@pytest.mark.parametrize("pairs", [EDGE_TEXTS, MIXED_TEXTS])
def test_cleaning(spark, pairs):
    rows = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(pairs)], "id long, question string")
    got = dict(map(tuple, rows.select("id", clean_question("question")).collect()))
    for i, (text, expected) in enumerate(pairs):
        assert got[i] == expected, text


def test_department_stays_after_a_deputy_and_goes_without(spark):
    rows = spark.createDataFrame([EDGE_TEXTS[0][:1], EDGE_TEXTS[1][:1]], "question string")
    assert column(rows.select(clean_question("question"))) == ["the minister for health", ""]


@pytest.mark.parametrize("pattern, hint", list(zip(BOILERPLATE, HINTS)))
def test_every_hint_is_part_of_every_match(pattern, hint):
    plain = re.sub(r"\\s[+*]", " ", pattern).replace(r"\b", "")
    for piece in (hint,) if hint else ():
        assert piece in plain
        assert not set(piece) & set("sik")
    if "minister for" in plain:
        assert MINISTER_HINTS[0] in plain


def test_cleaned_text_is_a_fixed_point_of_the_space_rule(spark):
    rows = spark.createDataFrame([(t,) for t, _ in EDGE_TEXTS], "question string")
    cleaned = rows.select(clean_question("question").alias("c"))
    assert all(c == " ".join(c.split()) for c in column(cleaned))


def test_spaces_and_word_counts(spark):
    texts = [" a  b c\n", "", None, "　", "one", "\x1ctwo\x1fwords"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert column(rows.select(normalise_spaces(F.col("t")))) == [" ".join((t or "").split()) for t in texts]
    assert column(rows.select(word_count(F.col("t")))) == [len((t or "").split()) for t in texts]


def test_model_input(spark):
    rows = spark.createDataFrame([(" Health ", "why"), (None, None)], "d string, q string")
    assert column(rows.select(model_input(F.col("d"), F.col("q")))) == [
        "[DEPT]  Health  [SEP] why",
        "[DEPT]  [SEP] ",
    ]
    assert column(rows.select(model_input(F.col("d"), F.col("q"), trim=True)))[0] == "[DEPT] Health [SEP] why"
    assert column(rows.select(model_input(F.col("d"), F.col("q"), "{question}"))) == ["why", ""]
