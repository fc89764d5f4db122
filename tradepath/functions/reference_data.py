"""Fixed lookup values of the marketplace domain. Every table here is small and constant."""

# The eight order statuses and five payment types.
ORDER_STATUSES = [
    "delivered", "shipped", "canceled", "unavailable",
    "invoiced", "processing", "created", "approved",
]
PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]

# Bounding box of the country.
LATITUDE_RANGE = (-34.0, 5.0)
LONGITUDE_RANGE = (-74.0, -28.0)

# State code -> state name.
STATE_NAMES = {
    "AC": "Acre", "AL": "Alagoas", "AP": "Amapá", "AM": "Amazonas", "BA": "Bahia",
    "CE": "Ceará", "DF": "Distrito Federal", "ES": "Espírito Santo", "GO": "Goiás",
    "MA": "Maranhão", "MT": "Mato Grosso", "MS": "Mato Grosso do Sul", "MG": "Minas Gerais",
    "PA": "Pará", "PB": "Paraíba", "PR": "Paraná", "PE": "Pernambuco", "PI": "Piauí",
    "RJ": "Rio de Janeiro", "RN": "Rio Grande do Norte", "RS": "Rio Grande do Sul",
    "RO": "Rondônia", "RR": "Roraima", "SC": "Santa Catarina", "SP": "São Paulo",
    "SE": "Sergipe", "TO": "Tocantins",
}

# Region -> state codes.
REGION_STATES = {
    "North": ["AC", "AP", "AM", "PA", "RO", "RR", "TO"],
    "Northeast": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "Centre-West": ["DF", "GO", "MT", "MS"],
    "Southeast": ["ES", "MG", "RJ", "SP"],
    "South": ["PR", "RS", "SC"],
}
STATE_REGIONS = {state: region for region, states in REGION_STATES.items() for state in states}

# The three states whose share of orders is tracked.
CORE_STATES = ["SP", "RJ", "MG"]

# Category name -> English label.
CATEGORY_ENGLISH = {
    "utilidades_domesticas": "home_utilities",
    "perfumaria": "perfumery",
    "automotivo": "automotive",
    "pet_shop": "pet_shop",
    "papelaria": "stationery",
    "unknown": "unknown",
    "moveis_decoracao": "furniture_decor",
    "moveis_escritorio": "office_furniture",
    "ferramentas_jardim": "tools_garden",
    "informatica_acessorios": "computing_accessories",
    "cama_mesa_banho": "bed_bath_table",
    "brinquedos": "toys",
    "construcao_ferramentas_construcao": "construction_tools_construction",
    "telefonia": "telephony",
    "beleza_saude": "beauty_health",
    "eletronicos": "electronics",
    "bebes": "baby",
    "cool_stuff": "cool_stuff",
    "relogios_presentes": "watches_gifts",
    "climatizacao": "air_conditioning",
    "esporte_lazer": "sports_leisure",
    "livros_interesse_geral": "books_general_interest",
    "eletroportateis": "small_appliances",
    "alimentos": "food",
    "malas_acessorios": "luggage_accessories",
    "fashion_underwear_e_moda_praia": "fashion_underwear_beachwear",
    "artigos_de_natal": "christmas_articles",
    "fashion_bolsas_e_acessorios": "fashion_bags_accessories",
    "instrumentos_musicais": "musical_instruments",
    "construcao_ferramentas_iluminacao": "construction_tools_lighting",
    "livros_tecnicos": "technical_books",
    "construcao_ferramentas_jardim": "construction_tools_garden",
    "eletrodomesticos": "home_appliances",
    "market_place": "market_place",
    "agro_industria_e_comercio": "agribusiness",
    "artigos_de_festas": "party_supplies",
    "casa_conforto": "home_comfort",
    "cds_dvds_musicais": "cds_dvds_music",
    "industria_comercio_e_negocios": "industry_commerce_business",
    "consoles_games": "consoles_games",
    "moveis_quarto": "bedroom_furniture",
    "construcao_ferramentas_seguranca": "construction_tools_safety",
    "telefonia_fixa": "landline_phones",
    "bebidas": "drinks",
    "moveis_cozinha_area_de_servico_jantar_e_jardim": "kitchen_service_dining_garden_furniture",
    "fashion_calcados": "fashion_shoes",
    "casa_construcao": "home_construction",
    "audio": "audio",
    "eletrodomesticos_2": "home_appliances_2",
    "fashion_roupa_masculina": "fashion_male_clothing",
    "cine_foto": "cinema_photography",
    "moveis_sala": "living_room_furniture",
    "artes": "arts",
    "alimentos_bebidas": "food_drinks",
    "tablets_impressao_imagem": "tablets_printing_image",
    "fashion_esporte": "fashion_sports",
    "portateis_cozinha_e_preparadores_de_alimentos": "portable_kitchen_food_preparers",
    "la_cuisine": "la_cuisine",
    "flores": "flowers",
    "pcs": "pcs",
    "casa_conforto_2": "home_comfort_2",
    "portateis_casa_forno_e_cafe": "portable_home_oven_coffee",
    "dvds_blu_ray": "dvds_blu_ray",
    "pc_gamer": "pc_gamer",
    "construcao_ferramentas_ferramentas": "construction_tools_tools",
    "fashion_roupa_feminina": "fashion_female_clothing",
    "moveis_colchao_e_estofado": "mattress_upholstered_furniture",
    "sinalizacao_e_seguranca": "signaling_safety",
    "fraldas_higiene": "diapers_hygiene",
    "livros_importados": "imported_books",
    "fashion_roupa_infanto_juvenil": "fashion_children_clothing",
    "musica": "music",
    "artes_e_artesanato": "arts_crafts",
    "seguros_e_servicos": "insurance_services",
}

# Categories the translation table lacks, mapped by hand.
CATEGORY_OVERRIDES = {
    "pc_gamer": "pc_gamer",
    "portateis_cozinha_e_preparadores_de_alimentos": "portable_kitchen_food_preparers",
    "unknown": "unknown",
}

# Payment type -> (display name, category, paid digitally).
PAYMENT_TYPE_DETAILS = {
    "credit_card": ("Credit Card", "Card", True),
    "debit_card": ("Debit Card", "Card", True),
    "boleto": ("Boleto", "Bank Slip", False),
    "voucher": ("Voucher", "Voucher", True),
    "not_defined": ("Not Defined", "Unknown", None),
}

# Accented letters and their plain forms, position by position.
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçñÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑ"
PLAIN = "aaaaaeeeeiiiiooooouuuucnAAAAAEEEEIIIIOOOOOUUUUCN"

# Words left out of term counts unless the caller gives a list.
STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of",
    "on", "or", "that", "the", "this", "to", "was", "with",
    "com", "da", "das", "de", "do", "dos", "e", "em", "na", "nas", "no", "nos", "o", "os",
    "ou", "para", "por", "que", "se", "um", "uma",
]

# Words that mark a delivery complaint.
DELIVERY_KEYWORDS = ["entrega", "prazo", "atraso"]
