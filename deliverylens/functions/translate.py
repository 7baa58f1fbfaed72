"""Category-code translation (lookup join with fallback)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The dashboard's category labels, code -> English label, in the
# reference's order. Two codes share "Garden Tools", so they merge when grouped.
CATEGORY_LABELS_EN = {
    "beleza_saude": "Health & Beauty",
    "informatica_acessorios": "Computers & Accessories",
    "automotivo": "Automotive",
    "cama_mesa_banho": "Bed, Bath & Table",
    "moveis_decoracao": "Furniture & Decor",
    "esporte_lazer": "Sports & Leisure",
    "perfumaria": "Perfumery",
    "utilidades_domesticas": "Home Utilities",
    "telefonia": "Telephony",
    "relogios_presentes": "Watches & Gifts",
    "alimentos_bebidas": "Food & Drink",
    "bebes": "Baby",
    "papelaria": "Stationery",
    "tablets_impressao_imagem": "Tablets, Printing & Image",
    "brinquedos": "Toys",
    "telefonia_fixa": "Fixed Telephony",
    "ferramentas_jardim": "Garden Tools",
    "fashion_bolsas_e_acessorios": "Fashion Bags & Accessories",
    "eletroportateis": "Small Appliances",
    "consoles_games": "Consoles & Games",
    "audio": "Audio",
    "fashion_calcados": "Fashion Shoes",
    "cool_stuff": "Cool Stuff",
    "malas_acessorios": "Luggage & Accessories",
    "climatizacao": "Air Conditioning",
    "construcao_ferramentas_construcao": "Construction Tools",
    "moveis_cozinha_area_de_servico_jantar_e_jardim": "Kitchen & Garden Furniture",
    "construcao_ferramentas_jardim": "Garden Tools",
    "fashion_roupa_masculina": "Men's Fashion",
    "pet_shop": "Pet Shop",
    "moveis_escritorio": "Office Furniture",
    "market_place": "Marketplace",
    "eletronicos": "Electronics",
    "eletrodomesticos": "Home Appliances",
    "artigos_de_festas": "Party Supplies",
    "casa_conforto": "Home Comfort",
    "construcao_ferramentas_ferramentas": "General Tools",
    "agro_industria_e_comercio": "Agro Industry",
    "moveis_colchao_e_estofado": "Mattress & Upholstery",
    "livros_tecnicos": "Technical Books",
    "casa_construcao": "Home Construction",
    "instrumentos_musicais": "Musical Instruments",
    "moveis_sala": "Living Room Furniture",
    "construcao_ferramentas_iluminacao": "Lighting Tools",
    "industria_comercio_e_negocios": "Industry & Commerce",
    "alimentos": "Food",
    "artes": "Art",
    "moveis_quarto": "Bedroom Furniture",
    "livros_interesse_geral": "General Books",
    "construcao_ferramentas_seguranca": "Safety Tools",
    "fashion_underwear_e_moda_praia": "Underwear & Beachwear",
    "fashion_esporte": "Sportswear",
    "sinalizacao_e_seguranca": "Signaling & Security",
    "pcs": "PCs",
    "artigos_de_natal": "Christmas Supplies",
    "fashion_roupa_feminina": "Women's Fashion",
    "eletrodomesticos_2": "Home Appliances 2",
    "livros_importados": "Imported Books",
    "bebidas": "Drinks",
    "cine_foto": "Cine & Photo",
    "la_cuisine": "La Cuisine",
    "musica": "Music",
    "casa_conforto_2": "Home Comfort 2",
    "portateis_casa_forno_e_cafe": "Home, Oven & Coffee",
    "cds_dvds_musicais": "CDs, DVDs & Music",
    "dvds_blu_ray": "DVDs & Blu-ray",
    "flores": "Flowers",
    "artes_e_artesanato": "Arts & Crafts",
    "fraldas_higiene": "Diapers & Hygiene",
    "fashion_roupa_infanto_juvenil": "Kids Fashion",
    "seguros_e_servicos": "Security & Services",
}

#: A lookup of at most so many labels is broadcast.
MOST_LABELS = 100_000

FALLBACKS = ("humanize", "constant", "original")


def label_map_column(mapping: dict[str, str]) -> Column:
    """A literal map usable in ``element_at``; evaluated JVM-side, no join."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.create_map(*pairs)


def _fallback(code: Column, fallback: str, constant: str) -> Column:
    if fallback == "humanize":
        return F.replace(code, F.lit("_"), F.lit(" "))
    if fallback == "constant":
        return F.lit(constant)
    if fallback == "original":
        return code
    raise ValueError(f"fallback must be one of {FALLBACKS}")


def translate_column(code: str | Column, mapping: dict[str, str],
                     fallback: str = "humanize", constant: str = "Unknown") -> Column:
    """Translate with a fixed (small, literal) mapping; no join needed."""
    code = F.col(code) if isinstance(code, str) else code
    return F.coalesce(F.element_at(label_map_column(mapping), code),
                      _fallback(code, fallback, constant))


def translate_codes(df: DataFrame, code_col: str, mapping: DataFrame | dict[str, str],
                    out_col: str, fallback: str = "humanize", constant: str = "Unknown",
                    key_col: str = "product_category_name",
                    label_col: str = "product_category_name_english") -> DataFrame:
    """Lookup LEFT join with fallback.

    A dict becomes a literal map expression (no shuffle at all). A DataFrame
    mapping is a lookup table, one label for each code. Up to ``MOST_LABELS``
    labels, which is counted, it is broadcast, so rows are not shuffled on a few
    codes; a longer one is joined as Spark sees fit. Where rows are only
    counted by label, count them by code first (``profile.item_category_ranking``).
    """
    if isinstance(mapping, dict):
        return df.withColumn(out_col, translate_column(code_col, mapping, fallback, constant))
    lookup = (mapping.groupBy(key_col).agg(F.min(label_col).alias("__label"))
              .withColumnRenamed(key_col, "__code"))
    if lookup.limit(MOST_LABELS + 1).count() <= MOST_LABELS:
        lookup = F.broadcast(lookup)
    joined = df.join(lookup, F.col(code_col) == F.col("__code"), "left")
    return (joined.withColumn(out_col, F.coalesce(F.col("__label"),
                                                  _fallback(F.col(code_col), fallback, constant)))
            .drop("__code", "__label"))


def read_translation_csv(spark: SparkSession, path: str) -> DataFrame:
    """The shipped ``category_translation.csv`` (code, English code)."""
    return spark.read.csv(path, header=True, schema="product_category_name string, "
                                                    "product_category_name_english string")
