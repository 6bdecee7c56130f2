"""Text and object labels of images."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagreef.functions.text import strip_tag
from tagreef.operators.grouping import first_per_key, ordered_concat
from tagreef.operators.sizes import broadcast_if_small
from tagreef.shared import saved

# Text languages in the order their texts are joined, and the
# translations there are.
LANGUAGES = ("eng", "chi_sim", "chi_tra")
TRANSLATED = (("en", "zh-CN"), ("zh-CN", "en"))


def concat_labels(detections: DataFrame) -> DataFrame:
    """``(path, labels)``: label names of an image in order, each followed by a blank."""
    spaced = detections.select("path", "pos", F.concat("name", F.lit(" ")).alias("name"))
    return ordered_concat(spaced, ["path"], "pos", {"name": "labels"})


def merge_ocr_text(texts: DataFrame, language: str = "all") -> DataFrame:
    """``(path, text)``: the texts of an image, all languages in order or one of them.

    Every path of ``texts`` has a row: the text is empty where no language asked
    for was read. Several texts of one language follow one another, sorted.
    """
    wanted = LANGUAGES if language == "all" else (language,)
    each = [
        F.array_sort(F.collect_list(F.when(F.col("lang") == lang, F.col("text")))) for lang in wanted
    ]
    merged = texts.groupBy("path").agg(F.array_join(F.flatten(F.array(*each)), "").alias("text"))
    return merged.select("path", strip_tag(F.col("text")).alias("text"))


def add_translations(labels: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Label rows with a ``translation`` column, NULL where there is none.

    English words go to Chinese and Chinese words to English; when a word is in
    the dictionary for both, it counts as English. The distinct words are looked
    up first; as long as the words found are small, no label row is shuffled.
    """
    known = known_translations(dictionary)
    words = saved(labels.select("name").distinct().join(known, "name"))
    return labels.join(broadcast_if_small(words), "name", "left").select(
        *labels.columns, "translation"
    )


def known_translations(dictionary: DataFrame) -> DataFrame:
    """``(name, translation)``, one for each word that a rule translates."""
    rule = F.lit(False)
    for source, target in TRANSLATED:
        rule = rule | ((F.col("src_lang") == source) & (F.col("dst_lang") == target))
    known = dictionary.filter(rule)
    known = first_per_key(
        known.select(F.col("term").alias("name"), "src_lang", "translation"), ["name"], ["src_lang"]
    )
    return known.select("name", "translation")


def label_texts(found: DataFrame, known: DataFrame) -> DataFrame:
    """``(image, labels)`` of rows ``(image, names)``: as :func:`row_label_text`, by a join.

    ``image`` is a row's own key, ``names`` its labels in order, ``known`` the words and
    their translations, one row each, of any number. Words travel with their image's
    key and place and come together again by the key; a common word is a key of
    many rows on one side only, which adaptive execution splits.
    """
    words = found.select("image", F.posexplode("names").alias("pos", "name"))
    met = words.join(known, "name").filter(F.col("translation").isNotNull())
    met = met.groupBy("image").agg(F.array_sort(F.collect_list(F.struct("pos", "translation"))).alias("met"))
    both = found.join(met, "image", "left")
    translated = F.transform("met", lambda m: F.concat(m["translation"], F.lit(" ")))
    text = F.concat(row_label_text(F.col("names")), F.coalesce(F.array_join(translated, ""), F.lit("")))
    return both.select("image", text.alias("labels"))


def row_label_text(labels: Column, translations: Column | None = None) -> Column:
    """As :func:`label_text`, of the labels array of a row and a map of translations."""

    def spaced(words: Column) -> Column:
        return F.array_join(F.transform(words, lambda word: F.concat(word, F.lit(" "))), "")

    labels = F.coalesce(labels, F.array().cast("array<string>"))
    if translations is None:
        return spaced(labels)
    found = F.filter(F.transform(labels, lambda word: translations[word]), lambda word: word.isNotNull())
    return F.concat(spaced(labels), spaced(found))


def label_text(detections: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """``(path, labels)``: labels in order, then once the translations in order."""
    if dictionary is None:
        return concat_labels(detections)
    both = add_translations(detections, dictionary)
    spaced = both.select(
        "path",
        "pos",
        F.concat("name", F.lit(" ")).alias("name"),
        F.coalesce(F.concat("translation", F.lit(" ")), F.lit("")).alias("translation"),
    )
    merged = ordered_concat(
        spaced, ["path"], "pos", {"name": "names", "translation": "translations"}
    )
    return merged.select("path", F.concat("names", "translations").alias("labels"))
