import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from suarakit.functions import category, pii, text

MASKED = [
    ("NIK saya 3578121504980001, saya", "NIK saya [NIK], saya"),
    ("di 081234567890 terkait", "di [PHONE] terkait"),
    ("Email saya budi@gmail.com,", "Email saya [EMAIL],"),
    ("Rekening saya 1234567890123456, tapi", "Rekening saya [REKENING], tapi"),
    ("NIK 3578121504980001, kontak 081234567890, email andi@mail.com.",
     "NIK [NIK], kontak [PHONE], email [EMAIL]."),
    ("kantor di 0317654321, ada", "kantor di [PHONE], ada"),
    ("Nomor 9999999999999999 muncul", "Nomor [REKENING]muncul"),
    ("021-1234567 atau 0812 3456 7890.", "[PHONE] atau [PHONE]."),
    ("NIK 3578121504980001 telp 081234567890 rekening 123456789012 email test@mail.com jalan",
     "NIK [NIK]telp [PHONE] rekening [REKENING]email [EMAIL] jalan"),
    ("NIK saya 3578011203456789", "NIK saya [NIK]"),
    ("Hubungi saya di 08123456789", "Hubungi saya di [PHONE]"),
    ("HP: +6281234567890", "HP: [PHONE]"),
    ("Telp 031-1234567", "Telp [PHONE]"),
    ("Email: hasan@gmail.com", "Email: [EMAIL]"),
    ("Rekening BCA saya 1234567890123456", "Rekening BCA saya [REKENING]"),
    ("Nama saya Budi, NIK 3578019876543210, bisa dihubungi di 08987654321 atau budi@email.com",
     "Nama saya Budi, NIK [REKENING], bisa dihubungi di [PHONE] atau [EMAIL]"),
    ("NIK 3578080812345678", "NIK 3578[PHONE]"),
    ("Jalan berlubang sudah 3 bulan, sekitar 10 meter di RT 05", None),
    ("Pelayanan di kelurahan sangat baik, hanya saja parkirnya kurang tertata.", None),
    ("", None),
    ("angka ￿ 1234567890 dan ￿0317654321", "angka ￿ [REKENING]dan ￿[PHONE]"),
]


def test_mask_pii_examples(apply):
    got = apply([a for a, _ in MASKED], pii.mask_pii)
    assert got == [a if b is None else b for a, b in MASKED]
    assert apply([None], pii.mask_pii) == [None]


NORMALISED = [
    ("Jln Rungkut Asri berlubang bgt, sdh 3 bulan tdk diperbaiki!!",
     "jalan rungkut asri berlubang banget, sudah 3 bulan tidak diperbaiki!"),
    ("Mhn segera ditindaklanjuti, banjir di kel. Gubeng udh parah bgt!!!",
     "mohon segera ditindaklanjuti, banjir di kelurahan. gubeng sudah parah banget!"),
    ("Tlg perbaiki lampu jalan yg mati di Wonokromo, udh gelap bgt",
     "tolong perbaiki lampu jalan yang mati di wonokromo, sudah gelap banget"),
    ("Sampah menumpuk di gg. Mawar RT 05 RW 02, baunya tdk tertahankan",
     "sampah menumpuk di gang. mawar rt 05 rw 02, baunya tidak tertahankan"),
    ("NIK saya [NIK], hubungi di [PHONE] atau [EMAIL]",
     "nik saya [NIK], hubungi di [PHONE] atau [EMAIL]"),
    ("yg yg\tYG (yg)", "yang yang yang yang"),
    ("a 12345 b !12345! 1234", "a b !! 1234"),
    ("", ""),
]


def test_normalise_examples(apply):
    assert apply([a for a, _ in NORMALISED], text.normalise) == [b for _, b in NORMALISED]


def test_slang_keeps_punctuation_and_case_of_other_words(apply):
    rows = ["YG,  (Tdk) ygx y.g .,ga,. thx", "  ", "Asap!", "KKP"]
    assert apply(rows, text.expand_slang) == [
        "yang, (tidak) ygx y.g .,tidak,. terima kasih", "", "segera!", "KKP"
    ]


def test_clean_examples(apply):
    rows = ["Lihat https://x.id/a?b=1 &amp; jalan #rusak @RT-05!", None, "a&&lt;b &AMP; c&x", "www.a b", "%%%"]
    assert apply(rows, text.clean_text) == ["Lihat jalan rusak RT-05!", "", "a b AMP; c x", "b", ""]


def test_category_examples(apply):
    rows = ["Jalan Rusak", "Persampahan", None, "  Pajak o'daerah ", "日a o'BRIEN-x 3abc foo_bar"]
    assert apply(rows, category.normalise_category) == [
        "Infrastruktur", "Kesehatan", "Lainnya", "  Pajak O'Daerah ", "日A O'Brien-X 3Abc Foo_Bar"
    ]


TEXTS = st.lists(
    st.text(alphabet=list("aZé1908²_ .,!?;:()-'&@#%\n\t 　|+x"), max_size=40), min_size=40, max_size=40
)
RELAXED = settings(
    max_examples=5, deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


@RELAXED
@given(TEXTS)
def test_title_case_is_pythons(apply, rows):
    assert apply(rows, text.title_case) == [r.title() for r in rows]


@RELAXED
@given(TEXTS)
def test_cleaning_twice_changes_nothing_and_never_lengthens(apply, rows):
    once = apply(rows, text.clean_text)
    # Removing a symbol can complete an entity's neighbourhood, never an entity itself.
    assert apply(once, text.clean_text) == once
    assert all(len(o) <= len(r) for o, r in zip(once, rows))


@RELAXED
@given(TEXTS)
def test_space_helpers_follow_python(apply, rows):
    from suarakit.functions.chars import is_blank, squeeze_space, strip_space

    assert apply(rows, strip_space) == [r.strip() for r in rows]
    assert apply(rows, squeeze_space) == [" ".join(r.split()) for r in rows]
    assert apply(rows, is_blank) == [not r.strip() for r in rows]


@RELAXED
@given(st.lists(st.text(alphabet=list("ab1.é_@- %|\n"), max_size=25), min_size=60, max_size=60))
def test_no_address_survives_masking(apply, rows):
    rows = [r + "x@ab.cd" + r[::-1] for r in rows]
    address = re.compile(r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b")
    masked = apply(rows, pii.mask_email)
    assert masked == [address.sub("[EMAIL]", r) for r in rows]


@RELAXED
@given(st.lists(st.text(alphabet=list("0168+23 -.éx"), max_size=30), min_size=60, max_size=60))
def test_both_ways_of_replacing_agree(apply, rows):
    mark = "￿"
    plain = apply(rows, pii.mask_pii)
    marked = apply([mark + " " + r for r in rows], pii.mask_pii)
    assert marked == [mark + " " + p for p in apply([" " + r for r in rows], lambda c: F.substr(pii.mask_pii(c), F.lit(2)))]
    assert all(not re.search(r"(?<!\w)\d{10,16}(?!\w)", p) for p in plain)


@pytest.mark.parametrize("fn", [text.clean_text, text.normalise, pii.mask_pii, category.normalise_category])
def test_text_functions_stay_in_the_jvm(spark, fn):
    df = spark.range(1).select(F.col("id").cast("string").alias("c")).select(fn(F.col("c")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_fixed_values():
    from suarakit import constants as K

    assert len(K.SLANG) == 40 and len(K.CATEGORY_KEYWORDS) == 18 and len(K.AREA_CODES) == 28


def test_tags_cannot_be_forged(apply):
    given = ["a __pii_nik__ b", "\uaa60a [NIK] \uaa60z", "[PHONE]123456 x", "__PII0__ [EMAIL][REKENING]"]
    assert apply(given, text.normalise) == [
        "a __pii_nik__ b", "\uaa60a [NIK] \uaa60z", "[PHONE]123456 x", "__pii0__ [EMAIL][REKENING]"
    ]


def test_joined_addresses_are_all_masked(apply):
    import random
    import re

    rule = re.compile(r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b")
    rng = random.Random(5)
    parts = ["budi@mail.com", "a@b.co", "@", ".", "-", "%", "+", "_", " ", "é", "1", "x", "com", "b.id", "|", ",", "@x.yz"]
    given = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 14))) for _ in range(3000)]
    given += ["budi@mail.com-andi@mail.com", "a@b.com.c@d.com", "a@b.com%c@d.com+e@f.id"]
    assert apply(given, pii.mask_email) == [rule.sub("[EMAIL]", t) for t in given]


def test_national_ids_in_any_digits(apply):
    from suarakit.functions.pii import is_valid_nik, mask_numbers

    given = ["3578010107901234", "٣٥٧٨٠١٠١٠٧٩٠١٢٣٤", "３５７８０１４１０７９０１２３４", "٣٥٧٨٠١٩٩٠٧٩٠١٢٣٤", "𝟑𝟓𝟕𝟖𝟎𝟏𝟎𝟏𝟎𝟕𝟗𝟎𝟏𝟐𝟑𝟒"]
    assert apply(given, is_valid_nik) == [True, True, True, False, True]
    assert apply(given[:4], mask_numbers) == ["[NIK]", "[NIK]", "[NIK]", "[REKENING]"]
