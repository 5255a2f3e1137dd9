"""Feature tables of the reference's three flows, as lazy DataFrame plans.

* ``lr3``   -- word-overlap flow: query length, search words found in title,
               description and aggregated attributes (E3).
* ``attr8`` -- attribute flow: product words found in the search term for
               title/description/brand/material, plus four edit ratios (E2 pass B).
* ``attr15`` / ``desc7`` -- add TF-IDF and word-vector cosines (E2 notebook, E1).

Per-product work (stemming, TF-IDF weights of descriptions) is done once per
product and joined to the pairs, never once per pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import fill_text, nan_text, overlap_count, word_count
from ..operators.attributes import aggregate_attributes
from ..operators.joins import left_join, product_dimension, with_attributes

# The feature column names of each set (names as in the reference,
# including its spelling of ``common_descriptoin``).
LR3 = ("query_len", "common_title", "common_descriptoin")
LR3_ATTR = LR3 + ("common_attributes",)
ATTR8 = ("common_title", "common_desc", "common_brand", "common_material",
         "dist_in_title", "dist_in_desc", "dist_in_brand", "dist_in_material")
ATTR15 = ATTR8 + ("tfidf_cos_sim_in_title", "tfidf_cos_sim_in_desc",
                  "tfidf_cos_sim_in_brand", "tfidf_cos_sim_in_material",
                  "w2v_cos_sim_in_title", "w2v_cos_sim_in_desc", "w2v_cos_sim_in_brand")
DESC6 = ("dist_in_title", "dist_in_desc", "tfidf_cos_sim_in_title",
         "tfidf_cos_sim_in_desc", "w2v_cos_sim_in_title", "w2v_cos_sim_in_desc")
# The reference leaves product_uid in its matrix (an unscaled id as a feature);
# that set is DESC7 and must be asked for explicitly; DESC6 is the default.
DESC7 = ("product_uid",) + DESC6


def lr3_features(pairs: DataFrame, descriptions: DataFrame,
                 attributes: DataFrame | None = None, stem: bool = False,
                 normalise_attributes: bool = False) -> DataFrame:
    """``(id, product_uid, relevance?, query_len, common_title,
    common_descriptoin[, common_attributes])``.

    Search words (F4b order) are counted in the title, the joined description
    and, when ``attributes`` is given, the aggregated attribute text (A1, J3).
    The reference's flow lower-cases and stems search term, title and
    description first (``stem``); without it the counts are taken on the texts
    as they are.  Attribute text is matched raw (case kept, unstemmed) unless
    ``normalise_attributes`` treats it the same way.
    """
    if stem:
        pairs, descriptions = stemmed_inputs(pairs, descriptions)
    d = left_join(pairs, descriptions)
    cols = [c for c in ("id", "product_uid", "relevance") if c in pairs.columns]
    out = d.select(
        *cols,
        word_count("search_term").alias("query_len"),
        overlap_count("search_term", "product_title").alias("common_title"),
        overlap_count("search_term", "product_description").alias("common_descriptoin"),
        F.col("search_term"))
    if attributes is not None:
        agg = aggregate_attributes(attributes)
        if normalise_attributes:
            from ..functions.stem import stem_columns
            agg = stem_columns(agg, ["product_attributes"])
        out = with_attributes(out, agg).withColumn(
            "common_attributes", overlap_count("search_term", "product_attributes"))
        out = out.drop("product_attributes")
    return out.drop("search_term")


def attr_base(pairs: DataFrame, descriptions: DataFrame, side: dict[str, DataFrame],
              keep_desc: bool = False) -> DataFrame:
    """The joined attribute-flow table (E2 up to the staging step):
    pairs ⟕ (description ⟕ bullets ⟕ brand ⟕ material); missing description,
    brand and material become a blank ``' '``."""
    dim = product_dimension(descriptions, bullets=side.get("bullets"), brand=side.get("brand"),
                            material=side.get("material"), keep_desc=keep_desc)
    d = left_join(pairs, dim)
    for c in ("product_description", "brand", "material"):
        d = d.withColumn(c, fill_text(c, " "))
    return d


def attr_overlap(base: DataFrame) -> DataFrame:
    """The four F4a counts: product-field words found in the search term."""
    return base.select(
        "*",
        *[overlap_count(src, "search_term").alias(name) for name, src in (
            ("common_title", "product_title"), ("common_desc", "product_description"),
            ("common_brand", "brand"), ("common_material", "material"))])


def attr_edit_ratios(base: DataFrame, fields=("title", "desc", "brand", "material")) -> DataFrame:
    """The F5 ratios ``dist_in_<field>`` between the search term and each field."""
    from ..functions.edit import edit_ratio
    from ..sources.csvio import by_key
    src = {"title": "product_title", "desc": "product_description",
           "brand": "brand", "material": "material"}
    return by_key(base, "id").select("*", *[edit_ratio("search_term", src[f]).alias(f"dist_in_{f}")
                                           for f in fields])


def attr8_features(pairs: DataFrame, descriptions: DataFrame,
                   side: dict[str, DataFrame]) -> DataFrame:
    """E2 pass B: ``(id, product_uid, relevance, <ATTR8>)``; raw pairs next to
    the stemmed side tables, as the reference reads them."""
    base = attr_base(pairs, descriptions, stemmed_side_tables(side))
    out = attr_edit_ratios(attr_overlap(base))
    return out.select("id", "product_uid", "relevance", *ATTR8)


def stemmed_inputs(pairs: DataFrame, descriptions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """F2 on the pair texts (per pair) and on descriptions (per product, before
    the join -- once per product, not once per pair)."""
    from ..functions.stem import stem_columns
    p = stem_columns(pairs, ["search_term", "product_title"])
    d = stem_columns(descriptions, ["product_description"])
    return p, d


def stemmed_side_tables(side: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Brand, material and bullets, lower-cased and stemmed (a null stays null)."""
    from ..functions.stem import stem_columns
    return {name: stem_columns(t, [c for c in t.columns if c != "product_uid"])
            for name, t in side.items()}


def w2v_features(pairs: DataFrame, products: DataFrame, fields: dict[str, str],
                 seed: int = 42, max_iter: int | None = None) -> DataFrame:
    """M23 + J5 + A6 + A7: train word vectors on the sentences of every pair's
    ``title . description .`` text (train and test rows, duplicates kept),
    then the search-term/field cosines per pair."""
    from ..operators.tfidf import corpus_text
    from ..operators.vectors import (VECTOR_SIZE, sentence_tokens, train_word2vec,
                                     vector_table, w2v_cosines)
    j = left_join(pairs, products)
    docs = j.select("id", corpus_text(F.col("product_title"),
                                      F.col("product_description")).alias("all_texts"))
    corpus = sentence_tokens(docs, "id", "all_texts")
    passes = {} if max_iter is None else {"max_iter": max_iter}
    model = train_word2vec(corpus, seed=seed, order=("id", "s_idx"), **passes)
    vectors = vector_table(model)
    # pair-owned texts per pair, product-owned texts once per product
    return w2v_cosines(pairs, vectors, fields, VECTOR_SIZE, products=products)


def desc7_features(pairs: DataFrame, descriptions: DataFrame, stem: bool = True,
                   seed: int = 42) -> DataFrame:
    """E1 (description flow): ``(id, relevance, product_uid, <DESC6>)`` --
    edit ratios, TF-IDF cosines and word-vector cosines of the search term
    against title and description.  Model on ``DESC6``, or on ``DESC7`` to
    reproduce the reference's matrix with the id in it."""
    from ..functions.edit import edit_ratio
    from ..operators.tfidf import tfidf_cosines
    from ..sources.csvio import by_key, stage

    p, d = stemmed_inputs(pairs, descriptions) if stem else (pairs, descriptions)
    p, d = stage(p), stage(d)        # reused by three feature branches
    j = by_key(left_join(p, d), "id")
    ratios = j.select("id", "product_uid", "relevance",
                      edit_ratio("search_term", "product_title").alias("dist_in_title"),
                      edit_ratio("search_term", "product_description").alias("dist_in_desc"))
    tf = tfidf_cosines(p, d, ("title", "desc"))
    wv = w2v_features(p, d, {"title": "product_title", "desc": "product_description"}, seed=seed)
    out = ratios.join(tf, "id", "left").join(wv, "id", "left")
    return out.select("id", "relevance", *DESC7)


def attr15_features(pairs: DataFrame, descriptions: DataFrame, attributes_long: DataFrame,
                    side: dict[str, DataFrame], seed: int = 42) -> DataFrame:
    """E2 notebook flow: stemmed texts; 4 overlaps, 4 edit ratios, 4 TF-IDF
    cosines (dictionary over title + description) and 3 word-vector cosines
    (material's is computed by the reference but left out of the matrix)."""
    from ..functions.stem import stem_columns
    from ..operators.tfidf import tfidf_cosines
    from ..sources.csvio import stage

    p, d = stemmed_inputs(pairs, descriptions)
    attrs = stem_columns(attributes_long, ["value"])
    side = {**stemmed_side_tables({k: t for k, t in side.items() if k != "bullets"}),
            "bullets": aggregate_attributes(attrs, out="bullets")}
    p = stage(p)
    # one row a product, built before the pairs come in; missing texts are 'nan'
    products = product_dimension(d, bullets=side["bullets"], brand=side["brand"], material=side["material"])
    for c in ("product_description", "brand", "material"):
        products = products.withColumn(c, nan_text(c))
    products = stage(products.select("product_uid", "product_description", "brand", "material"))
    base = left_join(p, products)
    feats = attr_edit_ratios(attr_overlap(base))
    pp = p.select("id", "product_uid", "search_term", "product_title")
    tf = tfidf_cosines(pp, products, ("title", "desc", "brand", "material"))
    wv = w2v_features(pp, products, {"title": "product_title", "desc": "product_description",
                                     "brand": "brand"}, seed=seed)
    out = feats.join(tf, "id", "left").join(wv, "id", "left")
    return out.select("id", "product_uid", "relevance", *ATTR15)
