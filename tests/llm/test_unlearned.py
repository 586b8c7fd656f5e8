"""Texts in languages that were not learned."""

import pytest

from footfall.llm import language
from tests.conftest import SF_DIR

OTHERS = [
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler.",
    "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza.",
    "Все люди рождаются свободными и равными в своем достоинстве и правах.",
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.mark.parametrize("learned", [["de", "en", "es", "fr"], ["de", "en"], ["en"]])
def test_unlearned_languages_go_and_learned_and_mixed_ones_stay(spark, docs, learned):
    clean = docs.filter(docs.lang.isin(learned) & (docs.n_chars > 0))
    model = language.fit(clean)
    assert model.languages == learned
    assert language.accepted(clean, model).count() == clean.count()
    assert language.accepted(spark.createDataFrame([(t,) for t in OTHERS], "text string"), model).count() == 0
    by_lang = {r.lang: r.text for r in clean.filter(clean.n_chars > 500).collect()}
    mixed = [(" ".join(by_lang[a].split()[:60] + by_lang[b].split()[:60]),) for a in learned for b in learned]
    assert language.accepted(spark.createDataFrame(mixed, "text string"), model).count() == len(mixed)
    if len(learned) < 4:
        other = docs.filter(~docs.lang.isin(learned) & (docs.n_chars > 500))
        assert language.accepted(other, model).count() < 0.05 * other.count()
