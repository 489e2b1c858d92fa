"""Names and labels that results must carry exactly."""

# Sentinel instants.
FAR_DATE = "9999-12-31"
NO_DATE = "1900-01-01"

# Plan names with a special role.
FREE_PLAN = "Gratuita"
ENTERPRISE_PLAN = "Empresarial"

# Defaults of the content staging table.
NO_TITLE = "Sin título"
NO_DESCRIPTION = "Sin descripción"
NO_TYPE = "Sin tipo"

# Attribute names read by the content pivot.
CATEGORY_ATTRIBUTE = "Categoría"
DURATION_ATTRIBUTE = "Duración"

# Plan change labels.
NEW_SUBSCRIPTION = "Nueva Suscripción"
UPGRADE = "Upgrade"
DOWNGRADE = "Downgrade"
SAME_SUBSCRIPTION = "Misma Suscripción"

# Segment shown for accounts that were never scored.
NO_SEGMENT = "Sin segmentación"

# Segment catalogue: name, description, rule text.
SEGMENTS = [
    ("Campeones",
     "Clientes con alta recency, frequency y monetary",
     "R≥4, F≥4, M≥4 - Clientes más valiosos, compran frecuentemente y recientemente"),
    ("Clientes Leales",
     "Clientes con alta recency y altos valores de frequency/monetary",
     "R≥4, F≥3, M≥3 - Clientes satisfechos que responden bien a promociones"),
    ("Clientes de Alto Valor",
     "Clientes con alta recency y monetary pero baja frequency",
     "R≥4, M≥4, F<3 - Clientes que gastan mucho pero no frecuentemente"),
    ("Clientes Potenciales",
     "Clientes con alta recency y valores medios de frequency/monetary",
     "R≥4, F≥2, M≥2 - Clientes con potencial de crecimiento"),
    ("Nuevos Clientes",
     "Clientes muy recientes con baja frequency y monetary",
     "R=5, F≤2, M≤2 - Clientes nuevos que necesitan ser retenidos"),
    ("Necesitan Atención",
     "Clientes con baja recency pero alta frequency y monetary",
     "R≤3, F≥4, M≥4 - Clientes valiosos que se están alejando"),
    ("En Riesgo",
     "Clientes con baja recency y valores medios de frequency/monetary",
     "R≤3, F≥2, M≥2 - Clientes en riesgo de abandono"),
    ("No se pueden perder",
     "Clientes con muy baja recency pero alta frequency y monetary",
     "R≤2, F≥4, M≥4 - Clientes críticos que necesitan atención inmediata"),
    ("Clientes Dormidos",
     "Clientes con muy baja recency, frequency y monetary",
     "R≤2, F≤2, M≤2 - Clientes inactivos"),
    ("Perdidos",
     "Clientes con valores muy bajos en todas las métricas",
     "R=1, F=1, M=1 - Clientes perdidos"),
    ("Clientes Regulares",
     "Clientes que no encajan en las categorías anteriores",
     "Cualquier otra combinación - Clientes con comportamiento estándar"),
]

# Segment rules, first match wins: name, then lowest and highest recency, frequency and
# monetary score.
SEGMENT_RULES = [
    ("Campeones", (4, 5), (4, 5), (4, 5)),
    ("Clientes Leales", (4, 5), (3, 5), (3, 5)),
    ("Clientes de Alto Valor", (4, 5), (1, 2), (4, 5)),
    ("Clientes Potenciales", (4, 5), (2, 5), (2, 5)),
    ("Nuevos Clientes", (5, 5), (1, 2), (1, 2)),
    ("Necesitan Atención", (1, 3), (4, 5), (4, 5)),
    ("En Riesgo", (1, 3), (2, 5), (2, 5)),
    ("No se pueden perder", (1, 2), (4, 5), (4, 5)),
    ("Clientes Dormidos", (1, 2), (1, 2), (1, 2)),
    ("Perdidos", (1, 1), (1, 1), (1, 1)),
]
OTHER_SEGMENT = "Clientes Regulares"

# Content types accepted by the content check.
CONTENT_TYPES = ["articulo", "proyecto", "linea_de_tiempo", "quiz"]

# E-mail format of the account check.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"

# Raw tables; True where rows carry updated_at and load incrementally.
RAW_TABLES = {
    "accounts": False,
    "accounts_subscription": False,
    "subscriptions": False,
    "contents": True,
    "content_attributes": True,
    "premium_features": False,
    "account_premium_features": False,
    "subscription_payments": False,
}

# Report file name stem and CRM property.
REPORT_STEM = "reporte_cuentas_enterprise"
CRM_PROPERTY = "segmento_rfm"
CRM_DEFAULT_LIMIT = 5
FRESHNESS_HOURS = 48
