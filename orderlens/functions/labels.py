"""Codes to reader-facing labels. An unmapped code is an error, never a blank."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.display import MISSING

# Label tables of the published dashboard.
SEGMENT_LABELS = {
    "A_HIGH_VALUE": "A · Alto valor",
    "B_MEDIUM_VALUE": "B · Valor medio",
    "C_LOW_VALUE": "C · Bajo valor",
    "NO_VALUE": "Sin valor elegible",
    "ONE_ITEM": "Una unidad",
    "TWO_TO_THREE": "De dos a tres unidades",
    "FOUR_PLUS": "Cuatro unidades o más",
    "SPECIALIST": "Especialista",
    "MIXED": "Mix de categorías",
    "DIVERSIFIED": "Diversificado",
    "UNKNOWN": "Sin categoría conocida",
}

# Label tables of the published dashboard.
DIMENSION_LABELS = {
    "VALUE": "Valor de compra",
    "UNITS": "Unidades compradas",
    "CATEGORIES": "Amplitud de categorías",
}

# Label tables of the published dashboard.
DELIVERY_STATUS_LABELS = {
    "ON_TIME": "A tiempo",
    "LATE": "Con demora",
    "UNKNOWN": "Sin estado informado",
}

# Label tables of the published dashboard.
CATEGORY_LABELS = {
    "agro_industry_and_commerce": "Agroindustria y comercio",
    "air_conditioning": "Climatización",
    "art": "Arte",
    "arts_and_craftmanship": "Arte y artesanías",
    "audio": "Audio",
    "auto": "Automotores",
    "baby": "Bebés",
    "bed_bath_table": "Dormitorio, baño y mesa",
    "books_general_interest": "Libros de interés general",
    "books_imported": "Libros importados",
    "books_technical": "Libros técnicos",
    "cds_dvds_musicals": "CD, DVD y musicales",
    "christmas_supplies": "Artículos navideños",
    "cine_photo": "Cine y fotografía",
    "computers": "Computación",
    "computers_accessories": "Accesorios de computación",
    "consoles_games": "Consolas y videojuegos",
    "construction_tools_construction": "Herramientas para construcción",
    "construction_tools_lights": "Iluminación para construcción",
    "construction_tools_safety": "Seguridad para construcción",
    "cool_stuff": "Artículos novedosos",
    "costruction_tools_garden": "Herramientas de jardín",
    "costruction_tools_tools": "Herramientas de construcción",
    "diapers_and_hygiene": "Pañales e higiene",
    "drinks": "Bebidas",
    "dvds_blu_ray": "DVD y Blu-ray",
    "electronics": "Electrónica",
    "fashio_female_clothing": "Indumentaria femenina",
    "fashion_bags_accessories": "Bolsos y accesorios",
    "fashion_childrens_clothes": "Indumentaria infantil",
    "fashion_male_clothing": "Indumentaria masculina",
    "fashion_shoes": "Calzado",
    "fashion_sport": "Indumentaria deportiva",
    "fashion_underwear_beach": "Ropa interior y de playa",
    "fixed_telephony": "Telefonía fija",
    "flowers": "Flores",
    "food": "Alimentos",
    "food_drink": "Alimentos y bebidas",
    "furniture_bedroom": "Muebles de dormitorio",
    "furniture_decor": "Muebles y decoración",
    "furniture_living_room": "Muebles de living",
    "furniture_mattress_and_upholstery": "Colchones y tapicería",
    "garden_tools": "Herramientas de jardinería",
    "health_beauty": "Salud y belleza",
    "home": "Hogar",
    "home_appliances": "Electrodomésticos",
    "home_appliances_2": "Electrodomésticos especiales",
    "home_comfort_2": "Confort para el hogar II",
    "home_confort": "Confort para el hogar",
    "home_construction": "Construcción para el hogar",
    "housewares": "Artículos para el hogar",
    "industry_commerce_and_business": "Industria, comercio y negocios",
    "kitchen_dining_laundry_garden_furniture": "Muebles de cocina, comedor, lavadero y jardín",
    "la_cuisine": "Cocina",
    "luggage_accessories": "Equipaje y accesorios",
    "market_place": "Mercado en línea",
    "music": "Música",
    "musical_instruments": "Instrumentos musicales",
    "office_furniture": "Muebles de oficina",
    "party_supplies": "Artículos para fiestas",
    "perfumery": "Perfumería",
    "pet_shop": "Mascotas",
    "security_and_services": "Seguridad y servicios",
    "signaling_and_security": "Señalización y seguridad",
    "small_appliances": "Pequeños electrodomésticos",
    "small_appliances_home_oven_and_coffee": "Pequeños electrodomésticos, hornos y café",
    "sports_leisure": "Deportes y tiempo libre",
    "stationery": "Librería",
    "tablets_printing_image": "Tabletas, impresión e imagen",
    "telephony": "Telefonía",
    "toys": "Juguetes",
    "unknown": "Sin categoría informada",
    "watches_gifts": "Relojes y regalos",
}


def label_or_null(code: Column, labels: Mapping[str, str]) -> Column:
    """Label of a code from a fixed table, NULL where there is none. The table travels as a literal."""
    entries = [F.lit(text) for pair in labels.items() for text in pair]
    return F.try_element_at(F.create_map(*entries), code)


def label(code: Column, labels: Mapping[str, str], kind: str) -> Column:
    """Label of a code; a query that meets a code without one fails there. ``require_labels`` names all."""
    failure = F.concat(F.lit(f"Faltan traducciones de {kind}: "), F.coalesce(code, F.lit(MISSING)))
    return F.coalesce(label_or_null(code, labels), F.raise_error(failure))


def unmapped(frame: DataFrame, code: str, labels: Mapping[str, str]) -> DataFrame:
    """Distinct codes without a label, a missing code shown as such."""
    missing = frame.filter(label_or_null(F.col(code), labels).isNull())
    return missing.select(F.coalesce(F.col(code), F.lit(MISSING)).alias(code)).distinct()
