"""What the language identifier rejects, and what it learns from."""

from __future__ import annotations

import base64
import os
import sys

import numpy as np
import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE)]

from llm_frames import make_docs  # noqa: E402

from playlens.llm import langid  # noqa: E402

SF = "/root/testdata/sf0.01"

#: Languages that the table does not have, in its script.
UNSEEN = [
    "La mattina presto il mercato della piccola città si riempie di gente che cerca verdura fresca e pane ancora caldo. "
    "I bambini corrono tra le bancarelle mentre i nonni parlano del tempo e dei vecchi amici.",
    "Wczesnym rankiem targ w małym mieście wypełnia się ludźmi, którzy szukają świeżych warzyw i jeszcze ciepłego chleba. "
    "Dzieci biegają między straganami, a dziadkowie rozmawiają o pogodzie i o starych przyjaciołach.",
    "Sabahın erken saatlerinde küçük şehrin pazarı taze sebze ve hâlâ sıcak ekmek arayan insanlarla dolar. "
    "Çocuklar tezgahların arasında koşarken dedeler havadan ve eski dostlardan konuşurlar.",
    "Varhain aamulla pienen kaupungin tori täyttyy ihmisistä, jotka etsivät tuoreita vihanneksia ja vielä lämmintä leipää. "
    "Lapset juoksevat kojujen välissä, kun isovanhemmat puhuvat säästä ja vanhoista ystävistä.",
    "Asubuhi na mapema soko la mji mdogo hujaa watu wanaotafuta mboga mpya na mkate ambao bado ni moto. "
    "Watoto hukimbia kati ya vibanda huku wazee wakizungumza kuhusu hali ya hewa na marafiki wa zamani.",
    "Sáng sớm chợ của thành phố nhỏ đầy người đi tìm rau tươi và bánh mì còn nóng. "
    "Trẻ em chạy giữa các quầy hàng trong khi ông bà nói chuyện về thời tiết và những người bạn cũ.",
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return langid.fit(docs.where(~langid.held_out()))


def test_unseen_languages_of_the_same_script_are_rejected(model):
    _, scores, rejected = model.predict(UNSEEN)
    assert rejected.all(), scores


@pytest.mark.parametrize("length", [40, 320, 2560, 20000])
def test_noise_is_rejected(model, length):
    rng = np.random.default_rng(length)
    letters, consonants = list("abcdefghijklmnopqrstuvwxyz"), list("bcdfghjklmnpqrstvwxz    ")
    noise = ["".join(rng.choice(letters, length)) for _ in range(10)]
    noise += ["".join(rng.choice(consonants, length)) for _ in range(10)]
    noise += [base64.b64encode(rng.bytes(length)).decode()[:length] for _ in range(10)]
    _, scores, rejected = model.predict(noise)
    assert rejected.all(), scores


def test_clean_documents_and_their_short_beginnings_stay(docs, model):
    held = [r["text"] for r in docs.where(langid.held_out()).collect() if r["text"]]
    for texts in (held, [t[:40] for t in held], [t[:200] for t in held]):
        assert model.predict(texts)[2].mean() <= 0.01


def test_floors_of_sizes_without_documents():
    measured = {"a": [(6, 0.5)] * 20 + [(8, 0.8)] * 20, "b": [(8, 0.4)] * 5}
    floors = langid.learn_floors(measured, ["a", "a", "b"])
    assert floors.shape == (3, langid.SIZES)
    a, b = floors[0] / langid.MARGIN, floors[2] / langid.MARGIN
    assert np.allclose(a[5:10], [0, 0.5, 0.5, 0.8, 0.8]) and (floors[0] == floors[1]).all()
    assert b[6] == 0.5 and 0.4 <= b[8] < 0.8  # few of its own: those of all languages
    assert not langid.learn_floors({}, ["a"]).any()


def test_rows_without_an_id_are_learned_from(spark):
    words = "der die das und ein Haus mit Garten am alten Fluss hinter dem kleinen Berg".split()
    german = [" ".join(words[i:] + words[:i]) for i in range(len(words))]
    english = [(i, f"the house with a garden near the old river number {i}", "en") for i in range(20)]
    without = make_docs(spark, english + [(None, t, "de") for t in german])
    model, numbered = langid.fit(without), langid.fit(make_docs(spark, english + [(100 + i, t, "de") for i, t in enumerate(german)]))
    assert model.languages == numbered.languages and "de" in model.languages
    assert np.allclose(model.centroids, numbered.centroids)
    assert model.predict(german)[0] == ["de"] * len(german)


def test_sample_holds_whole_documents_once(spark):
    """Repeated rows without an id neither multiply in the sample nor crowd out others."""
    rows = [(None, "das gleiche Haus am Fluss", "de")] * 40 + [(None, f"ein anderer Garten {w}", "de") for w in ("Berg", "Tal", "See")]
    model = langid.fit(make_docs(spark, rows), per_language=4, clusters=1)
    mean = model.vectors(langid.ngram_counts([r[1] for r in rows[39:]])).mean(axis=0)
    assert np.allclose(model.centroids, mean / np.linalg.norm(mean), atol=1e-5)
