"""Values fixed by the data and the business rules: codes, labels, texts, thresholds.

Nothing here is computed; results are only right when these match the source data.
"""

# --- Fixed values: portfolio filters --------------------------------------------------
NETWORKS = ("AGENT", "COURTIER", "SALARIE GPROX")
PRODUCT_FAMILY = "SANTE INDIVIDUELLE"
EXCLUDED_PARTNER_CODE = 2
INDIVIDUAL_PRODUCT = "I"
PADDED_COMPANIES = ("07", "59", "01", "81", "76", "57")
POLICY_WIDTH = 11
OPEN_END = "9999-12-01"

# --- Fixed values: columns of the portfolio tables -------------------------------------
CARRIED = (
    "identifiantrce", "contratactif", "libcsp", "top_mar_part", "top_mar_prope", "top_mar_ent",
    "precisionsystemeorigine", "libformejuridique", "formejuridique", "rce_lib_produit",
)
COLLECTOR_CONTRACT = (
    "cdcompagnie", "cdappli", "cdproduit", "nucontra", "cdciegen", "idintermagi", "idinterm", "dtsaisie",
    "idsouscragi", "dtsouscr", "dteffet", "dtterme", "cdtypterme", "cdsituat", "dtsituat", "lbsouscr",
)
COLLECTOR_PRODUCT = ("cdcompagnie", "cdappli", "cdproduit", "lbproduit", "lbcommercial", "cdcollindiv")

# --- Fixed values: product scopes -----------------------------------------------------
LINE_PATTERN_COLLECTOR = "SANTéIS"
LINE_PATTERN_BASE = "SANTEIS"
SENIOR_PATTERN = "FORMULE 3S|FORMULE 3S+|FORMULE 5S"
SELF_EMPLOYED_REF = "A246"
PRIVATE_REF = "A241"
SINGLE_PRODUCT_CODE = "460"
SCOPES = ("top_santeis_senior", "top_santeis_clas", "top_ideo", "top_tns", "top_part", "top_autre")

# --- Fixed values: department number -> dial prefix -----------------------------------
DIAL_PREFIX = {
    1: "04", 2: "03", 3: "04", 4: "04", 5: "04", 6: "04", 7: "04", 8: "03", 9: "04", 10: "03",
    11: "04", 12: "04", 13: "04", 14: "02", 15: "04", 16: "05", 17: "05", 18: "02", 19: "05", 20: "04",
    21: "03", 22: "02", 23: "05", 24: "05", 25: "03", 26: "04", 27: "02", 28: "02", 29: "02", 30: "04",
    31: "04", 32: "04", 33: "05", 34: "04", 35: "02", 36: "02", 37: "02", 38: "04", 39: "03", 40: "05",
    41: "02", 42: "04", 43: "04", 44: "02", 45: "02", 46: "04", 47: "05", 48: "04", 49: "02", 50: "02",
    51: "03", 52: "03", 53: "02", 54: "03", 55: "03", 56: "02", 57: "03", 58: "03", 59: "03", 60: "03",
    61: "02", 62: "03", 63: "04", 64: "05", 65: "04", 66: "04", 67: "03", 68: "03", 69: "04", 70: "03",
    71: "03", 72: "02", 73: "04", 74: "04", 75: "01", 76: "02", 77: "01", 78: "01", 79: "05", 80: "03",
    81: "04", 82: "04", 83: "04", 84: "04", 85: "02", 86: "05", 87: "05", 88: "03", 89: "03", 90: "03",
    91: "01", 92: "01", 93: "01", 94: "01", 95: "01", 97: "-",
}
NO_PREFIX = "-"

# --- Fixed values: product ladder (code, next code, family, label) --------------------
PRODUCT_LADDER = (
    ("SATEI-FM01", "SATEI-FM02", "CLASSIQUE", "SANTEIS CLASSIQUE F1"),
    ("SATEI-FM02", "SATEI-FM03", "CLASSIQUE", "SANTEIS CLASSIQUE F2"),
    ("SATEI-FM03", "SATEI-FM04", "CLASSIQUE", "SANTEIS CLASSIQUE F3"),
    ("SATEI-FM04", "SATEI-FM05", "CLASSIQUE", "SANTEIS CLASSIQUE F4"),
    ("SATEI-FM05", "SATEI-FM06", "CLASSIQUE", "SANTEIS CLASSIQUE F5"),
    ("SATEI-FM06", "SATEI-FM06", "CLASSIQUE", "SANTEIS CLASSIQUE F6"),
    ("SATEI-FS03", "SATEI-FS3P", "SENIOR", "SANTEIS SENIOR F3"),
    ("SATEI-FS3P", "SATEI-FS05", "SENIOR", "SANTEIS SENIOR F3+"),
    ("SATEI-FS05", "SATEI-FS05", "SENIOR", "SANTEIS SENIOR F5"),
)
SENIOR_ENTRY = "SATEI-FS03"
CLASSIC_ENTRY = "SATEI-FM03"
OTHER_FAMILY = "AUTRE"

# --- Fixed values: segmentation -------------------------------------------------------
SENIOR_FORMULA = "SANTEIS_SENIOR"
CLASSIC_FORMULA = "SANTEIS_CLASSIQUE"
LABEL_FORMULA_STEP = "Montée de formule"
LABEL_PRODUCT_STEP = "Montée de produit"
LABEL_LOYALTY = "Bonus fidélité"
REGIME_SPECIAL = ("Alsace Moselle", "3")
LEGAL_PUBLIC = ("Fonctionnaire", "3")

# --- Fixed values: campaign -----------------------------------------------------------
TARGET_PROPOSALS = (
    "GAV", "GAV, SANTEIS", "SANTEIS", "SERENIVIE", "SERENIVIE, GAV",
    "SERENIVIE, GAV, SANTEIS", "SERENIVIE, SANTEIS",
)
CONTACTS_PER_WAVE = 17000
CONTROLS_PER_WAVE = 800
MIN_AGE = 18
MAX_AGE = 80
HISTORY_MONTHS = 9
ADVISOR_LEVEL = 5
CAMPAIGN_PREFIX = "OF_R2_MRH_Vague "
APP_COLUMNS = (
    "identifiantrce", "nom", "prenom", "campagne", "age_assure", "libcsp", "telephone", "nomrue",
    "localite", "formule", "prime", "rac", "message1", "message2", "id_contrat", "type_contrat",
    "cc_nom", "cc_prenom", "indicatif",
)

# --- Fixed values: message texts ------------------------------------------------------
ONLY_HOME = "Le client ne détient que de la MRH"
ALSO_HOLDS = "En plus de la MRH, le client détient également le(s) produit(s) suivant(s) : "
AVERAGE_RISK = "Le risque de résiliation du client est dans la moyenne"
FRAGILE_BECAUSE = "Le client est jugé fragile car : "
CLIENT_WORDS = "le client"
CLIENT_PRONOUN = "il"
NO_REASONS = "[]"
NO_APPETITE = "Le client n'a a priori pas d'appétence particulière à un produit"
HAS_APPETITE = "Le client a le profil type des clients appétents à "
NO_ADVISOR = "Néanmoins, il n'est rattaché a priori à aucun CC"
ACCIDENT_LINE = "GAV"
ACCIDENT_OFFER = "Il est conseillé de proposer au client une GAV "
ACCIDENT_FAMILY = " car sa situation familiale est "
PRICE_IS = "le tarif proposé est: "
ACCIDENT_LOW = " EUR pour une IP de 5%"
ACCIDENT_HIGH = " EUR pour une IP de 30%. "
ACCIDENT_PRICES = {"Solo": ("146.97", "120.27"), "Famille": ("267.03", "213.61")}
HEALTH_LINE = "SANTEIS"
HEALTH_OFFER = "Il est conseillé de proposer au client un contrat SANTEIS ("
HEALTH_FORMULAS = {"SATEI-FM03": "Formule 3 CLASSIQUE", "SATEI-FS03": "Formule 3 SENIOR"}
FUNERAL_LINE = "SERENIVIE"
FUNERAL_OFFER = "Il est conseillé de proposer au client un contrat SERENIVIE ("
FUNERAL_FORMULAS = {
    "PRESTIGE": "Paiement VIAGER - Formule PRESTIGE",
    "REFERENCE": "Paiement VIAGER - Formule REFERENCE",
}
PRICE_IS_ABOUT = "le tarif proposé est environ: "
CURRENCY_END = " EUR. "

# --- Fixed values: month labels, January to December ----------------------------------
MONTH_NAMES = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
MONTH_LABELS = ("Jan", "Fev", "Mar", "Avr", "Mai", "Juin", "Juil", "Aout", "Sept", "Oct", "Nov", "Dec")
