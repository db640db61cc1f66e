"""Label lists, cue words, patterns, thresholds, weights and texts.

Everything in this module is a value the results depend on.  There is no logic
here; the operators combine these values into Spark expressions.  Patterns are
written once, in portable form, and get their flags where they are used.
"""

# --- fixed values: contract types and other label lists ----------------------

CONTRACT_TYPES = [
    "MODIFICATION_AND_CLOSURE",
    "CORPORATE_AND_STRUCTURAL",
    "FINANCE_AND_TREASURY",
    "INDIVIDUAL_LABOUR",
    "REAL_ESTATE_AND_FACILITIES",
    "IP_LICENSING_AND_TECH",
    "SUPPLY_AND_TRADE",
    "SERVICES",
    "LEGAL_SETTLEMENT_AND_RIGHTS",
]

PERIODICITIES = [
    "ONE_OFF",
    "MONTHLY",
    "QUARTERLY",
    "SEMI_ANNUAL",
    "ANNUAL",
    "MILESTONE_BASED",
    "USAGE_BASED",
    "ON_DELIVERY",
    "OTHER",
]

LANGUAGES = ["en", "fr", "mixed"]

SECTORS = [
    "Banking & Financial Markets",
    "Insurance & Pensions",
    "Digital Infrastructure",
    "Managed ICT & Security Services (MSP/MSSP)",
    "Energy",
    "Transport",
    "Health & Life Sciences",
    "Manufacturing (Critical Goods)",
    "Water & Wastewater",
    "Public Administration & Defence",
    "Space & Satellite Infrastructure",
    "Digital Providers (Platforms)",
    "Food, Waste & Postal Services",
    "Chemical & Nuclear",
    "Research Organizations",
    "High-Risk AI",
]

LEVERAGE_LABELS = ["SUPPLIER", "CUSTOMER", "BALANCED", "UNCLEAR"]
OWNERSHIP_LABELS = ["SUPPLIER", "CUSTOMER", "JOINT", "UNCLEAR"]
SCOPE_LABELS = ["MUTUAL", "UNILATERAL_SUPPLIER", "UNILATERAL_CUSTOMER", "NONE", "UNCLEAR"]

# --- fixed values: extraction fields and their routing -----------------------

EVIDENCE_FIELDS = [
    "primary_contract_type",
    "internal_entity",
    "business_unit",
    "sales_owner",
    "legal_owner",
    "counterparty_name",
    "counterparty_contact_email",
    "counterparty_signatory",
    "signature_date",
    "effective_date",
    "start_date",
    "end_date",
    "auto_renewal",
    "renewal_notice_days",
    "termination_notice_days",
    "contract_term",
    "total_contract_value",
    "currency",
    "payment_periodicity",
    "payment_terms_days",
    "indexation",
]
ALL_FIELDS = ["language", *EVIDENCE_FIELDS]

TEXT_FIRST_FIELDS = [
    "primary_contract_type",
    "counterparty_name",
    "counterparty_signatory",
    "signature_date",
    "effective_date",
    "start_date",
    "end_date",
    "auto_renewal",
    "renewal_notice_days",
    "termination_notice_days",
    "contract_term",
    "currency",
    "payment_periodicity",
    "payment_terms_days",
]
MODEL_ONLY_FIELDS = [
    "internal_entity",
    "counterparty_contact_email",
    "total_contract_value",
    "indexation",
]
ROUTED_FIELDS = [*TEXT_FIRST_FIELDS, *MODEL_ONLY_FIELDS]

FIELD_TYPES = {
    "auto_renewal": "boolean",
    "renewal_notice_days": "int",
    "termination_notice_days": "int",
    "payment_terms_days": "int",
    "total_contract_value": "double",
}  # every other field is a string

FIELD_LABELS = {
    "language": LANGUAGES,
    "primary_contract_type": CONTRACT_TYPES,
    "payment_periodicity": PERIODICITIES,
}

LOCK_THRESHOLDS = {
    "primary_contract_type": 0.85,
    "counterparty_name": 0.92,
    "counterparty_signatory": 0.92,
    "signature_date": 0.95,
    "effective_date": 0.95,
    "start_date": 0.95,
    "end_date": 0.95,
    "auto_renewal": 0.95,
    "renewal_notice_days": 0.9,
    "termination_notice_days": 0.9,
    "contract_term": 0.9,
    "currency": 0.9,
    "payment_periodicity": 0.9,
    "payment_terms_days": 0.95,
}

# --- fixed values: sizes -----------------------------------------------------

HEADER_LINES = 40
REQUEST_CHARS = 12000
SNIPPET_EDGE_LINES = 60
PARAGRAPH_MIN_CHARS = 30
MODEL_CONFIDENCE = 0.6

# --- fixed values: contract-type keywords, most decisive type first ----------

TYPE_KEYWORDS = {
    "MODIFICATION_AND_CLOSURE": [
        "amendment", "addendum", "change order", "extension", "termination", "termination notice",
        "waiver", "avenant", "résiliation", "resiliation", "prorogation", "renewal letter",
    ],
    "CORPORATE_AND_STRUCTURAL": [
        "shareholders", "articles of association", "board resolution", "share purchase agreement",
        "stock purchase agreement", "corporate resolution",
    ],
    "FINANCE_AND_TREASURY": [
        "loan agreement", "facility agreement", "credit agreement", "guarantee", "promissory note",
        "intercompany loan",
    ],
    "INDIVIDUAL_LABOUR": [
        "employment agreement", "employment contract", "contrat de travail", "salary", "paid leave",
        "lien de subordination", "employee", "salarié",
    ],
    "REAL_ESTATE_AND_FACILITIES": [
        "lease agreement", "commercial lease", "bail commercial", "lease", "bail", "premises",
        "locaux", "construction contract", "epc",
    ],
    "IP_LICENSING_AND_TECH": [
        "saas", "software license", "licence", "license agreement", "platform access", "logiciel",
        "subscription services",
    ],
    "SUPPLY_AND_TRADE": [
        "supply agreement", "purchase order", "sale of goods", "logistics",
        "distribution agreement", "fourniture", "vente", "livraison",
    ],
    "SERVICES": [
        "services agreement", "master services agreement", "statement of work", "consulting",
        "professional services", "prestations de services", "assistance", "conseil",
    ],
    "LEGAL_SETTLEMENT_AND_RIGHTS": [
        "nda", "non-disclosure", "confidentiality agreement", "settlement agreement", "release",
        "power of attorney",
    ],
}
TYPE_CONFIDENCE = 0.88

# --- fixed values: dates -----------------------------------------------------

DATE_PATTERN = (
    r"(?:\d{4}[/-]\d{1,2}[/-]\d{1,2}|"
    r"\d{1,2}[/-]\d{1,2}[/-]\d{4}|"
    r"\d{1,2}\s+[A-Za-zÀ-ÿ]+\s+\d{4}|"
    r"[A-Za-zÀ-ÿ]+\s+\d{1,2},?\s+\d{4})"
)
MONTHS = {
    "january": 1, "janvier": 1,
    "february": 2, "fevrier": 2,
    "march": 3, "mars": 3,
    "april": 4, "avril": 4,
    "may": 5, "mai": 5,
    "june": 6, "juin": 6,
    "july": 7, "juillet": 7,
    "august": 8, "aout": 8,
    "september": 9, "septembre": 9,
    "october": 10, "octobre": 10,
    "november": 11, "novembre": 11,
    "december": 12, "decembre": 12,
}  # looked up after accent folding
DATE_LABELS = {
    "signature_date": ["signature date", "date of signature", "executed on", "signed on", "execution date"],
    "effective_date": ["effective date", "date d'effet", "prise d'effet", "entry into force", "entrée en vigueur"],
    "start_date": ["start date", "commencement date", "service commencement", "date de début", "date de debut"],
    "end_date": ["end date", "expiry date", "expiration date", "date de fin", "échéance", "echeance"],
}
DATE_CONFIDENCE = 0.95

# --- fixed values: parties and signatories -----------------------------------

ROLE_LABELS = [
    "customer", "client", "vendor", "supplier", "provider", "contractor", "consultant",
    "licensor", "licensee", "buyer", "seller", "prestataire", "fournisseur",
]
ROLE_CONFIDENCE = 0.96
ROLE_NOTE = "Role-labeled counterparty name match."
PAIR_PATTERNS = [
    r"\bbetween\s+([^,\n;()]+?)\s+and\s+([^,\n;()]+?)(?:\s*\(|,|\n|$)",
    r"\bentre\s+([^,\n;()]+?)\s+et\s+([^,\n;()]+?)(?:\s*\(|,|\n|$)",
]
PAIR_CONFIDENCE = 0.7
PAIR_NOTE = "Fallback assumption: second named party in a two-party definition."
SIGNATORY_PATTERNS = [
    r"(?:for and on behalf of|on behalf of|pour le compte de)\s+"
    r"(?:customer|client|vendor|supplier|provider|contractor|consultant|prestataire|fournisseur)[^\n]*"
    r"(?:\n.{0,120}){0,4}?\b(?:name|nom)\s*[:\-]\s*([A-Z][^\n,:;]{2,80})",
    r"^\s*(?:customer|client|vendor|supplier|provider|contractor|consultant|prestataire|fournisseur)\s*[:\-].*?"
    r"(?:\n.{0,120}){0,4}?\b(?:by|name|nom)\s*[:\-]\s*([A-Z][^\n,:;]{2,80})",
]
# a line that may start a block of each shape, and the lines after it that belong to the block
SIGNATORY_CUES = [
    r"(?i)behalf of|pour le compte de",
    r"(?iU)^\s*(?:customer|client|vendor|supplier|provider|contractor|consultant|prestataire|fournisseur)\s*(?:[:\-]|$)",
]
SIGNATORY_LINES = 5
SIGNATORY_CONFIDENCE = 0.95

# --- fixed values: clause rules (matched on folded clauses) ------------------

RENEWAL_NEGATIVE = [
    r"\bno automatic renewal\b",
    r"\bwithout automatic renewal\b",
    r"\bshall not renew automatically\b",
    r"\bwill not renew automatically\b",
    r"\bsans reconduction tacite\b",
    r"\bsans renouvellement automatique\b",
    r"\bne sera pas renouvele automatiquement\b",
]
RENEWAL_POSITIVE = [
    r"\bautomatic renewal\b",
    r"\bautomatically renew",
    r"\brenew automatically\b",
    r"\bevergreen\b",
    r"\btacite reconduction\b",
    r"\brenouvellement automatique\b",
]
RENEWAL_STEMS = ["renew", "reconduction", "renouvel", "evergreen"]  # each pattern above has one
RENEWAL_CONFIDENCE = 0.95

RENEWAL_NOTICE_CUES = ["renew", "reconduction", "renouvellement"]
TERMINATION_NOTICE_CUES = ["terminate", "termination", "resiliation"]
MONTH_WORDS = ["month", "mois"]
NOTICE_PATTERNS = [
    r"\b(\d{1,3})\s+days?\b",
    r"\b(\d{1,3})\s+calendar\s+days?\b",
    r"\bpreavis\s+de\s+(\d{1,3})\s+jours\b",
    r"\bdelai\s+de\s+preavis\s+de\s+(\d{1,3})\s+jours\b",
]
NOTICE_CONFIDENCE = 0.9

TERM_CUES = ["term", "duration", "duree"]
TERM_INDEFINITE = ["indefinite", "until terminated", "duree indeterminee"]
TERM_INDEFINITE_CONFIDENCE = 0.92
TERM_ENGLISH = (
    r"\b(?:initial\s+term|term|duration)\b.{0,60}?\b(\d{1,3})\s+(months?|years?)\b"
    r".{0,40}?\bfrom\s+(effective date|start date|commencement date)\b"
)
TERM_FRENCH = (
    r"\bduree\b.{0,40}?\b(\d{1,3})\s+(mois|ans?|annees?)\b.{0,40}?\ba compter de\b"
    r".{0,20}?\b(date d'effet|date de debut|prise d'effet)\b"
)
TERM_CONFIDENCE = 0.9
TERM_UNTIL = r"\buntil\b\s+(" + DATE_PATTERN + ")"
TERM_UNTIL_CONFIDENCE = 0.88
TERM_YEARS = r"\b(\d{1,3})\s+(years?|ans?|annees?)\b"
TERM_MONTHS = r"\b(\d{1,3})\s+(months?|mois)\b"

PAYMENT_CUES = [
    "fee", "fees", "price", "pricing", "pay", "payable", "invoice", "billing", "charge",
    "subscription", "rent", "loyer", "factur", "paiement", "redevance", "tarif",
]
PAYMENT_TERMS = [
    r"\bnet\s+(\d{1,3})\b",
    r"\bwithin\s+\w+\s*\((\d{1,3})\)\s+days\b",
    r"\bwithin\s+(\d{1,3})\s+days\b",
    r"\bpayable\s+within\s+(\d{1,3})\s+days\b",
    r"\bdans un delai de\s+(\d{1,3})\s+jours\b",
    r"\bpaiement sous\s+(\d{1,3})\s+jours\b",
]
PAYMENT_TERMS_CONFIDENCE = 0.95

PERIODICITY_PATTERNS = {
    "MONTHLY": [
        r"\bbilled monthly\b",
        r"\binvoiced monthly\b",
        r"\binvoices? (?:are )?issued monthly\b",
        r"\bpaid monthly\b",
        r"\bpayable monthly\b",
        r"\bmonthly (?:fee|fees|payment|payments|invoice|billing)\b",
        r"\bper month\b",
        r"\bmensuel\b",
        r"\bmensuellement\b",
        r"\bpar mois\b",
    ],
    "QUARTERLY": [
        r"\bbilled quarterly\b",
        r"\binvoiced quarterly\b",
        r"\binvoices? (?:are )?issued quarterly\b",
        r"\bpaid quarterly\b",
        r"\bpayable quarterly\b",
        r"\bquarterly (?:fee|fees|payment|payments|invoice|billing)\b",
        r"\bper quarter\b",
        r"\btrimestriel\b",
        r"\btrimestriellement\b",
    ],
    "SEMI_ANNUAL": [
        r"\bbilled semi[- ]annually\b",
        r"\binvoiced semi[- ]annually\b",
        r"\binvoices? (?:are )?issued semi[- ]annually\b",
        r"\bpaid semi[- ]annually\b",
        r"\bpayable semi[- ]annually\b",
        r"\bsemi[- ]annual (?:fee|fees|payment|payments|invoice|billing)\b",
        r"\bsemi[- ]annual\b",
        r"\bsemiannual\b",
        r"\bsemi-annuel\b",
    ],
    "ANNUAL": [
        r"\bbilled annually\b",
        r"\binvoiced annually\b",
        r"\binvoices? (?:are )?issued annually\b",
        r"\bpaid annually\b",
        r"\bpayable annually\b",
        r"\bannual (?:fee|fees|payment|payments|invoice|billing)\b",
        r"\bper year\b",
        r"\bannuel\b",
        r"\bannuellement\b",
    ],
    "MILESTONE_BASED": [r"\bmilestone\b", r"\bjalon\b"],
    "USAGE_BASED": [r"\busage[- ]based\b", r"\bper api call\b", r"\bper use\b", r"\bselon l'utilisation\b"],
    "ON_DELIVERY": [r"\bon delivery\b", r"\bupon delivery\b", r"\ba la livraison\b"],
    "ONE_OFF": [r"\bone[- ]off\b", r"\bone time\b", r"\bsingle payment\b", r"\blump sum\b", r"\bforfait unique\b"],
}
PERIODICITY_STEMS = {
    "MONTHLY": ["month", "mensuel", "par mois"],
    "QUARTERLY": ["quarter", "trimestriel"],
    "SEMI_ANNUAL": ["semi"],
    "ANNUAL": ["annual", "per year", "annuel"],
    "MILESTONE_BASED": ["milestone", "jalon"],
    "USAGE_BASED": ["usage", "per api call", "per use", "selon l'utilisation"],
    "ON_DELIVERY": ["on delivery", "a la livraison"],
    "ONE_OFF": ["one", "single payment", "lump sum", "forfait unique"],
}  # each pattern above contains one of its stems
PERIODICITY_CONFIDENCE = 0.92
PERIODICITY_MIXED_CONFIDENCE = 0.7
PERIODICITY_MIXED_NOTE = "Multiple explicit billing cadences detected."
PERIODICITY_MIXED_WARNING = (
    "Multiple payment cadences detected locally; returning OTHER for payment_periodicity."
)
PRICE_CHANGE_CUES = ["increase", "adjust", "uplift", "revision"]

# --- fixed values: e-mail ----------------------------------------------------

EMAIL_PATTERN = r"\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b"
EXTERNAL_CONTACT_CUES = [
    "counterparty", "customer", "client", "vendor", "supplier", "provider", "contractor",
    "consultant", "licensor", "licensee", "prestataire", "fournisseur", "cocontractant", "external",
]
INTERNAL_CONTACT_CUES = [
    "company", "our", "internal", "legal", "finance", "accounts payable", "comptabilite", "juridique",
]
EMAIL_CONFIDENCE = 0.96

# --- fixed values: money -----------------------------------------------------

CURRENCY_CODES = {
    "EUR": "EUR", "USD": "USD", "GBP": "GBP", "CHF": "CHF", "CAD": "CAD", "AUD": "AUD",
    "JPY": "JPY", "US$": "USD", "C$": "CAD", "€": "EUR", "£": "GBP",
}
CURRENCY_TOKENS = r"\b(?:USD|EUR|GBP|CHF|CAD|AUD|JPY)\b|US\$|C\$|€|£"
CURRENCY_CONFIDENCE = 0.75
TOTAL_LABELS = [
    "total fees", "total fee", "total amount", "contract value", "total contract value",
    "total price", "montant total", "prix total", "valeur totale du contrat",
    "minimum commitment", "minimum annual commitment",
]
TOTAL_CURRENCY = r"USD|EUR|GBP|CHF|CAD|AUD|JPY|US\$|C\$|€|£"
TOTAL_AMOUNT = r"\d{1,3}(?:[ \u00A0.,]\d{3})*(?:[.,]\d{1,2})?|\d+(?:[.,]\d{1,2})?"
TOTAL_ANNUAL_CUE = "annual commitment"
TOTAL_CONFIDENCE = 0.96
TOTAL_CURRENCY_CONFIDENCE = 0.95
TOTAL_ONE_YEAR_NOTE = "Explicit annual commitment for a 12-month committed term."
TOTAL_DERIVED_NOTE = "Annual commitment multiplied by explicit committed term (%s)"

# --- fixed values: indexation, in order of preference ------------------------

INDEXATION_GATE = [
    "cpi", "ipc", "ilc", "ilat", "icc", "syntec", "inflation", "indexation", "revision", "increase by",
]
INDEXATION_NAMES = [
    ("Syntec index", ["syntec"], 0.95),
    ("ILC index", ["ilc"], 0.95),
    ("ILAT index", ["ilat"], 0.95),
    ("ICC index", ["icc"], 0.95),
    ("Annual CPI adjustment", ["cpi", "consumer price index", "ipc"], 0.92),
    ("Annual inflation-linked adjustment", ["inflation"], 0.9),
]
INDEXATION_PERCENT = r"(\d+(?:[.,]\d+)?)\s*%"
INDEXATION_YEARLY = ["annual", "anniversary", "chaque annee", "each year", "every year"]
INDEXATION_PERCENT_CONFIDENCE = 0.9

# --- fixed values: language cues (counted in folded text) --------------------

FRENCH_CUES = ["le present", "contrat", "date d'effet", "parties", "societe", "duree", "renouvellement", "resiliation"]
ENGLISH_CUES = [
    "this agreement", "effective date", "whereas", "party", "parties", "term", "termination", "renewal",
]

# --- fixed values: governing-law categories, first hit wins ------------------

LAW_CATEGORIES = [
    ("french", ["french", "france", "droit français", "droit francais"]),
    ("english", ["english", "england", "laws of england"]),
    ("us_ny", ["new york", "delaware", "laws of the state"]),
    ("german", ["german", "deutsches"]),
    ("dutch", ["dutch", "netherlands"]),
]

# --- fixed values: model requests --------------------------------------------

HIGH_CONTEXT_FIELDS = [
    "language", "primary_contract_type", "internal_entity", "counterparty_name", "counterparty_signatory",
]
SNIPPET_KEYWORDS = {
    "language": ["whereas", "attendu", "agreement", "contrat"],
    "primary_contract_type": ["amendment", "addendum", "agreement", "contract", "avenant", "termination", "license", "services", "lease", "loan"],
    "internal_entity": ["between", "among", "party", "parties", "signature", "signed by", "for and on behalf of"],
    "business_unit": ["business unit", "division", "department"],
    "sales_owner": ["sales owner", "account owner", "commercial owner"],
    "legal_owner": ["legal owner", "legal contact", "counsel", "juridique"],
    "counterparty_name": ["between", "among", "party", "parties", "signature", "signed by"],
    "counterparty_contact_email": ["email", "e-mail", "courriel", "notice"],
    "counterparty_signatory": ["signature", "signed by", "for and on behalf of", "name:", "titre"],
    "signature_date": ["signature", "executed", "signed on", "dated"],
    "effective_date": ["effective date", "date d'effet", "prise d'effet", "entry into force", "entrée en vigueur"],
    "start_date": ["start date", "commencement", "date de début", "service commencement", "debut"],
    "end_date": ["end date", "expiration", "expiry", "date de fin", "échéance", "echeance"],
    "auto_renewal": ["automatic renewal", "tacite reconduction", "renew automatically", "renouvellement automatique"],
    "renewal_notice_days": ["renewal", "renew", "reconduction", "renouvellement", "notice", "préavis", "preavis"],
    "termination_notice_days": ["termination", "terminate", "resiliation", "résiliation", "notice", "préavis", "preavis"],
    "contract_term": ["term", "duration", "durée", "duree", "initial term"],
    "total_contract_value": ["total fees", "total amount", "contract value", "montant total", "prix total", "minimum commitment"],
    "currency": ["eur", "usd", "gbp", "chf", "cad", "€", "$", "£"],
    "payment_periodicity": ["monthly", "quarterly", "annually", "monthly fee", "facture", "mensuel", "trimestriel"],
    "payment_terms_days": ["net 30", "payable within", "within", "invoice", "paiement", "facture"],
    "indexation": ["cpi", "ipc", "ilc", "ilat", "icc", "syntec", "inflation", "indexation", "révision", "revision"],
}
REQUEST_RULES = {
    "language": "Set to en, fr, mixed, or null based only on the provided snippets.",
    "primary_contract_type": "Choose exactly one taxonomy value or null. Modification/termination documents always map to MODIFICATION_AND_CLOSURE.",
    "internal_entity": "Return the internal signing entity only if clearly identified in party definitions or signature blocks.",
    "business_unit": "Return only if an internal business unit or division is explicitly named.",
    "sales_owner": "Return only if an internal commercial owner is explicitly named.",
    "legal_owner": "Return only if an internal legal owner or counsel is explicitly named.",
    "counterparty_name": "Return the external legal contracting party only if explicit.",
    "counterparty_signatory": "Return the external signatory only if explicit.",
    "counterparty_contact_email": "Return the external counterparty contact email only if explicit.",
    "signature_date": "Return the signature or execution date normalized to YYYY-MM-DD.",
    "effective_date": "Return the effective date normalized to YYYY-MM-DD.",
    "start_date": "Return the contract or service start date normalized to YYYY-MM-DD.",
    "end_date": "Return an explicit end date normalized to YYYY-MM-DD. Derive only if explicit base date plus fixed term are both stated.",
    "auto_renewal": "Return true only for explicit automatic or tacit renewal, false only for explicit no-auto-renewal language, else null.",
    "renewal_notice_days": "Return the day count needed to prevent renewal only if explicit in days.",
    "termination_notice_days": "Return the ordinary termination notice period in days only if explicit.",
    "contract_term": "Normalize concise text such as '12 months from Effective Date', 'until 2028-12-31', or 'indefinite'.",
    "total_contract_value": "Return only a binding committed total amount. Do not infer from incomplete pricing.",
    "currency": "Normalize to an ISO 4217 code only if unambiguous.",
    "payment_periodicity": "Return one enum value only if the billing cadence is explicit.",
    "payment_terms_days": "Return invoice payment days such as Net 30 or payable within 45 days.",
    "indexation": "Return a short normalized description of any explicit indexation or annual uplift mechanism, else null.",
}
REQUEST_TAXONOMY = """\
MODIFICATION_AND_CLOSURE: amendments, addenda, extensions, waivers, renewals, terminations.
CORPORATE_AND_STRUCTURAL: shareholders agreements, articles, SPAs, board resolutions.
FINANCE_AND_TREASURY: loans, facilities, guarantees, intercompany debt.
INDIVIDUAL_LABOUR: employment or individual worker agreements with payroll/subordination cues.
REAL_ESTATE_AND_FACILITIES: leases, deeds, construction, fixed infrastructure.
IP_LICENSING_AND_TECH: SaaS, software licenses, platform access, IP licensing.
SUPPLY_AND_TRADE: sale, supply, distribution, logistics of physical goods.
SERVICES: consulting, professional services, statements of work, agency work.
LEGAL_SETTLEMENT_AND_RIGHTS: NDAs, settlements, releases, powers of attorney."""
REQUEST_OPENING = [
    "You are a bilingual legal contract extraction engine for English and French contracts.",
    "Extract only the requested fields from the provided snippets.",
    "Be conservative: never guess, never use outside knowledge, and return null if the value is absent, ambiguous, conflicting, or weakly implied.",
    "Return JSON only and match the schema exactly.",
    "For every non-null requested field with evidence, provide a short verbatim quote from the snippets.",
    "For every field that is not in requested_fields, return null and empty evidence.",
]
CLASSIFY_REQUEST_HEAD = "Classify the following contract document.\n\n<contract_text>\n"
CLASSIFY_REQUEST_TAIL = (
    "\n</contract_text>\n\nRespond with ONLY the JSON object as specified. No other text."
)
CONFLICT_WARNING = "Conflicting local matches for %s; leaving it for LLM resolution."
PART_CONFLICT_WARNING = "The parts of the request have different answers for %s; it is left empty."
PART_MISSING_WARNING = "%d of %d parts of the request have no answer."
# kinds of failure of an answer
NO_OBJECT, BAD_ANSWER = "ValueError", "ValidationError"
FAILED_WARNING = "LLM fallback failed (%s); unresolved fields remain null."
# no credential is ever read here, so the reason names the missing answer instead
SKIPPED_WARNING = "LLM fallback skipped because there is no answer; unresolved fields remain null."

# --- fixed values: error texts of response ingestion -------------------------

ERR_NULL_CONTENT = "Model returned null content (possible content filter or empty response)"
ERR_NO_OBJECT = "No JSON object found in model response"
ERR_UNBALANCED = "Unbalanced braces in model response — JSON object not closed"
ERR_PARSE = "JSON parse error"

# --- fixed values: risk vector layout, weights, thresholds -------------------

VECTOR_LABELS = [
    "termination_risk", "data_sensitivity", "payment_risk", "auto_renewal_risk",
    "liability_cap_adequacy_inv",
    "leverage_SUPPLIER", "leverage_CUSTOMER", "leverage_BALANCED", "leverage_UNCLEAR",
    "ip_SUPPLIER", "ip_CUSTOMER", "ip_JOINT", "ip_UNCLEAR",
    "scope_MUTUAL", "scope_UNILATERAL_SUPPLIER", "scope_UNILATERAL_CUSTOMER", "scope_NONE",
    "scope_UNCLEAR",
    "cap_present", "cap_formula_multiplier", "mutual_cap", "carveout_count_norm",
    "indemnity_uncapped", "mutual_indemnity", "payment_due_days_norm", "late_interest_present",
    "auto_renewal_present", "nonrenewal_notice_days_norm",
]
DEFAULT_WEIGHTS = {
    "termination_risk": 0.18,
    "data_sensitivity": 0.14,
    "liability_cap_adequacy": 0.16,
    "payment_risk": 0.12,
    "auto_renewal_risk": 0.06,
    "leverage_SUPPLIER": 0.05,
    "ip_CUSTOMER": 0.04,
    "scope_UNILATERAL_SUPPLIER": 0.03,
    "scope_NONE": 0.04,
    "indemnity_uncapped": 0.06,
    "cap_present_inv": 0.05,
    "payment_due_risk": 0.04,
    "late_interest_absent": 0.03,
}
# term name -> (weight name, vector label, inverted?), in summation order of the score
SCORE_TERMS = [
    ("termination_risk", "termination_risk", "termination_risk", False),
    ("data_sensitivity", "data_sensitivity", "data_sensitivity", False),
    ("payment_risk", "payment_risk", "payment_risk", False),
    ("auto_renewal_risk", "auto_renewal_risk", "auto_renewal_risk", False),
    ("liability_cap_adequacy_inv", "liability_cap_adequacy", "liability_cap_adequacy_inv", False),
    ("leverage_SUPPLIER", "leverage_SUPPLIER", "leverage_SUPPLIER", False),
    ("ip_CUSTOMER", "ip_CUSTOMER", "ip_CUSTOMER", False),
    ("scope_UNILATERAL_SUPPLIER", "scope_UNILATERAL_SUPPLIER", "scope_UNILATERAL_SUPPLIER", False),
    ("scope_NONE", "scope_NONE", "scope_NONE", False),
    ("cap_absent", "cap_present_inv", "cap_present", True),
    ("indemnity_uncapped", "indemnity_uncapped", "indemnity_uncapped", False),
    ("payment_due_risk", "payment_due_risk", "payment_due_days_norm", False),
    ("late_interest_absent", "late_interest_absent", "late_interest_present", True),
]
HIGH_SCORE = 4
LOW_CAP_SCORE = 2
LONG_PAYMENT_DAYS = 60
HIGH_COMPOSITE = 0.65

FLAG_TERMINATION = "HIGH termination risk (score %s/5): unilateral or short-notice termination right present."
FLAG_CAP = "Liability cap inadequate or absent (score %s/5): exposure may be disproportionate to contract value."
FLAG_DATA = (
    "HIGH data sensitivity (score %s/5): special-category or sensitive personal data processed — "
    "GDPR Art. 9 / Art. 28 review required."
)
FLAG_PAYMENT = "HIGH payment risk (score %s/5): vague payment triggers, long terms, or no late-payment remedy."
FLAG_RENEWAL = (
    "Auto-renewal trap (score %s/5): opt-out window is very short or unclear — calendar management required."
)
FLAG_LEVERAGE = (
    "Counterparty leverage: SUPPLIER — obligations and risk fall disproportionately on the supplying party."
)
FLAG_IP = (
    "IP ownership: assigned to CUSTOMER — verify scope of the assignment clause; pre-existing IP and "
    "background IP carve-outs."
)
FLAG_SCOPE_NONE = (
    "Confidentiality: NO clause detected — confidential information exchanged under this contract is unprotected."
)
FLAG_SCOPE_SUPPLIER = (
    "Confidentiality: UNILATERAL (supplier only) — only the supplier is bound; customer's obligations to keep "
    "information confidential are absent or unclear."
)
FLAG_INDEMNITY = (
    "Indemnity: UNCAPPED — indemnification obligation has no stated monetary ceiling; exposure is potentially "
    "unlimited."
)
FLAG_PAYMENT_DAYS = "Payment terms: %s days — longer than the 60-day threshold."
FLAG_RENEWAL_NO_NOTICE = (
    "Auto-renewal: clause detected but no opt-out notice period found — renewal may be unconditional."
)
FLAG_COMPOSITE = "Composite risk score %s ≥ 0.65 threshold — overall risk profile is elevated."
