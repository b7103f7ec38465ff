"""Fixed business vocabularies.

FIXED VALUES -- these must equal the source system's vocabularies for the
results to be right; they are stated here plainly, in their natural order.
"""

# FIXED VALUES: the eight order statuses Silver accepts.
ORDER_STATUSES = [
    "DELIVERED", "SHIPPED", "PROCESSING", "CANCELED", "UNAVAILABLE",
    "INVOICED", "CREATED", "APPROVED",
]

# FIXED VALUES: the five payment types Silver accepts.
PAYMENT_TYPES = ["CREDIT_CARD", "BOLETO", "VOUCHER", "DEBIT_CARD", "NOT_DEFINED"]

# FIXED VALUES: payment types that get their own per-order amount column.
PAYMENT_TYPE_COLUMNS = [
    ("CREDIT_CARD", "credit_card_amount"),
    ("BOLETO", "boleto_amount"),
    ("VOUCHER", "voucher_amount"),
    ("DEBIT_CARD", "debit_card_amount"),
]

# FIXED VALUES: product category translation (Portuguese -> English).
# Categories not listed keep their (lower-cased) source name.
CATEGORY_TRANSLATIONS = {
    "beleza_saude": "health_beauty",
    "informatica_acessorios": "computers_accessories",
    "automotivo": "auto",
    "cama_mesa_banho": "bed_bath_table",
    "moveis_decoracao": "furniture_decor",
    "esporte_lazer": "sports_leisure",
    "perfumaria": "perfumery",
    "utilidades_domesticas": "housewares",
    "telefonia": "telephony",
    "relogios_presentes": "watches_gifts",
    "alimentos_bebidas": "food_drink",
    "bebes": "baby",
    "papelaria": "stationery",
    "tablets_impressao_imagem": "tablets_printing_image",
    "brinquedos": "toys",
    "telefonia_fixa": "fixed_telephony",
    "ferramentas_jardim": "garden_tools",
    "fashion_bolsas_e_acessorios": "fashion_bags_accessories",
    "eletroportateis": "small_appliances",
    "consoles_games": "consoles_games",
    "audio": "audio",
    "fashion_calcados": "fashion_shoes",
    "cool_stuff": "cool_stuff",
    "malas_acessorios": "luggage_accessories",
    "climatizacao": "air_conditioning",
    "construcao_ferramentas_construcao": "construction_tools",
    "moveis_cozinha_area_de_servico_jantar_e_jardim": "kitchen_dining_laundry_garden_furniture",
    "construcao_ferramentas_iluminacao": "construction_tools_lighting",
    "artigos_de_festas": "party_supplies",
    "livros_interesse_geral": "books_general_interest",
    "eletronicos": "electronics",
    "pet_shop": "pet_shop",
    "pcs": "pcs",
}

# FIXED VALUES: state code -> macro region; anything else is "Unknown".
REGION_STATES = [
    ("Southeast", ["SP", "RJ", "MG", "ES"]),
    ("South", ["PR", "SC", "RS"]),
    ("Northeast", ["BA", "PE", "CE", "MA", "PI", "RN", "PB", "SE", "AL"]),
    ("Central-West", ["GO", "MT", "MS", "DF"]),
    ("North", ["AM", "PA", "AC", "RO", "RR", "AP", "TO"]),
]
UNKNOWN_REGION = "Unknown"

# FIXED VALUES: product size bands by weight in grams (upper bounds, exclusive).
SIZE_BANDS = [(500, "Small"), (2000, "Medium"), (10000, "Large")]
SIZE_BAND_TOP = "Extra Large"

# FIXED VALUES: customer value segments by lifetime value (lower bounds, exclusive).
VALUE_SEGMENTS = [(500, "High Value"), (200, "Medium Value")]
VALUE_SEGMENT_LOW = "Low Value"

# FIXED VALUES: order-item sanity bound on price (exclusive upper bound).
MAX_ITEM_PRICE = 100000

# FIXED VALUES: clickstream event types and device types.
CLICK_EVENT_TYPES = ["page_view", "search", "add_to_cart", "purchase"]
DEVICE_TYPES = ["mobile", "desktop", "tablet"]
