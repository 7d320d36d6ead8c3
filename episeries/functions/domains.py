"""Names, codes and phrases the results depend on.

Fixed values: each list below is dictated by the published inputs or by the
published result contract, so it is written out as plain text.
"""

# Reserved members of the dimension columns.
NATIONAL = "España"
TOTAL = "total"
UNKNOWN = "unknown"
GENDERS = ["M", "F", "total"]

# The regions, spelt as results show them.
REGIONS = [
    "Andalucía", "Aragón", "Asturias", "Baleares", "Canarias", "Cantabria",
    "Castilla-La Mancha", "Castilla y León", "Cataluña", "Ceuta",
    "Comunidad Valenciana", "Extremadura", "Galicia", "Madrid", "Melilla",
    "Murcia", "Navarra", "País Vasco", "La Rioja",
]

# Region labels of the population file.
POPULATION_REGION_LABELS = {
    "Total Nacional": "España",
    "01 Andalucía": "Andalucía",
    "02 Aragón": "Aragón",
    "03 Asturias, Principado de": "Asturias",
    "04 Balears, Illes": "Baleares",
    "05 Canarias": "Canarias",
    "06 Cantabria": "Cantabria",
    "07 Castilla y León": "Castilla y León",
    "08 Castilla - La Mancha": "Castilla-La Mancha",
    "09 Cataluña": "Cataluña",
    "10 Comunitat Valenciana": "Comunidad Valenciana",
    "11 Extremadura": "Extremadura",
    "12 Galicia": "Galicia",
    "13 Madrid, Comunidad de": "Madrid",
    "14 Murcia, Región de": "Murcia",
    "15 Navarra, Comunidad Foral de": "Navarra",
    "16 País Vasco": "País Vasco",
    "17 Rioja, La": "La Rioja",
    "18 Ceuta": "Ceuta",
    "19 Melilla": "Melilla",
}

# Gender codes of the three delimited files.
DAILY_GENDER_CODES = {"H": "M", "M": "F", "NC": "unknown"}
POPULATION_GENDER_LABELS = {"Hombres": "M", "Mujeres": "F", "Ambos sexos": "total"}
DEATHS_GENDER_LABELS = {"Total": "total", "Hombres": "M", "Mujeres": "F"}

# Ordered (pattern, replacement) pairs for age labels.
POPULATION_AGE_PATTERNS = [
    (r"\*", ""),
    (r" *[\(\)] *", ""),
    (r"Todas las edades", "total"),
    (r"Total", "total"),
    (r"Menores de ([0-9]*) año", "0-$1"),
    (r"De ([0-9]*) a ([0-9]*) años", "$1-$2"),
    (r"De ([0-9]*) años y más", "≥$1"),
    (r"([0-9]*) y más años", "≥$1"),
]
DEATHS_AGE_PATTERNS = [
    (r"\*", ""),
    (r" *[\(\)] *", ""),
    (r"Todas las edades", "total"),
    (r"Menos de ([0-9]*) año", "0-$1"),
    (r"De ([0-9]*) a ([0-9]*) años", "$1-$2"),
    (r"([0-9]*) y más años", "$1+"),
]

# The code in front of a cause of death, and the all-causes label.
CAUSE_CODE_PATTERN = r"[0-9A-Z\- ]+\."
ALL_CAUSES = "Todas las causas"
COVID_CAUSE = "COVID-19"

# Selected reference periods.
POPULATION_PERIOD = "1 de enero de 2020"
DEATHS_PERIOD = 2018
SYMPTOMS_DATE = "2020-05-29"
FIRST_DEATHS_DATE = "2020-03-15"

# Symptom names shown in results.
SYMPTOM_LABELS = {
    "aki": "Infección aguda de riñón",
    "dhiarrea": "Diarrea",
    "other_respiratory": "Otras afecciones respiratorias",
    "vomit": "Vómitos",
    "dyspnoea": "Disnea",
    "fever": "Fiebre",
    "ards": "Síndrome de dificultad respiratoria aguda",
    "cough": "Tos",
    "sore_throat": "Dolor de garganta",
}

# Symptom phrases in the weekly reports, in matching order.
SYMPTOM_PHRASES = [
    ("fiebre o reciente historia de fiebre", "fever"),
    ("tos", "cough"),
    ("dolor de garganta", "sore_throat"),
    ("disnea", "dyspnoea"),
    ("escalofríios", "chill"),
    ("vómitos", "vomit"),
    ("diarrea", "dhiarrea"),
    ("neumonía (rx o clínica)", "pneumonia"),
    ("neumonía (radiológica o clínica)", "pneumonia"),
    ("sdra", "ards"),
    ("síndrome de distrés respiratorio agudo", "ards"),
    ("otros síntomas resp.", "other_respiratory"),
    ("fallo renal agudo", "aki"),
    ("otros síntomas", "others"),
]
ILLNESS_PHRASES = [
    ("enfermedad de base y factores de riesgo", "enfermedades_previas"),
    ("enfermedades y factores de riesgo", "enfermedades_previas"),
]
SYMPTOM_REPORTS = (16, 33)
TRANSMISSION_FIRST_REPORT = 34

# Fixed values: (lead phrase, characters to skip) before a report's date.
DATE_LEADS = [
    ("Fecha del informe: ", 0),
    ("Situación de COVID-19 en España a ", 0),
    ("Informe COVID-2019 nº ", 3),
    ("Informe SARS-CoV-2 nº ", 3),
    ("Informe COVID-19 nº ", 3),
    ("Informe COVID–19 . ", 0),
]
MONTHS = [
    "enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto",
    "septiembre", "octubre", "noviembre", "diciembre",
]

# Titles that identify a table in the daily reports.
TABLE_TITLES = {
    "hospital_pressure": r"Tabla [1-9]+\. Situación capacidad asistencial",
    "hospital_cases": r"Tabla [1-9]+\. Casos (de )?COVID-19.+, ingreso en UCI",
    "outbreaks_description":
        r"Tabla [0-9]+\. Distribución del nº de brotes y casos por ámbito",
}
NUMBERED_TITLE = r"Tabla ([0-9]+)[a-z]?[.,]"
IC_BEDS_PHRASE = "% Camas Ocupadas UCI COVID"
PER_INHABITANTS_PHRASE = "Tasa de ocupación hospitalaria por 100.000"
OUTBREAK_HEADER = "Casos/brote"

# Spellings joined into one word before a page is tokenised.
REGION_PHRASES = [
    ("Castilla La Mancha", "Castilla_La_Mancha"),
    ("Castilla-La Mancha", "Castilla_La_Mancha"),
    ("C. Valenciana", "Comunidad_Valenciana"),
    ("C Valenciana", "Comunidad_Valenciana"),
    ("País Vasco", "País_Vasco"),
    ("Castilla y León", "Castilla_y_León"),
    ("La Rioja", "La_Rioja"),
    ("Total general", "ESPAÑA"),
    ("Total", "ESPAÑA"),
    ("Islas Baleares", "Baleares"),
    ("Islas Canarias", "Canarias"),
]
# The trailing U+10FFFF is no character; a class that reaches beyond the basic
# plane takes a JVM regex path whose speed does not fall with the thread count.
PAGE_NOISE = r"[^A-zÀ-ú0-9,.<>≤≥ \-\x{10ffff}]"
SYMPTOM_NOISE = r"[^A-zÀ-ú0-9,. \-<>\x{10ffff}]"
WORD_START = r"^[A-zÀ-ú_]"

# Row labels and text repairs of the outbreak table.
OUTBREAK_SCOPES = [
    "Centro_educativo", "Centro_sanitario", "Centro_sociosanitario",
    "Colectivos_socialmente_vulnerables", "Familiar", "Mixto", "Laboral",
    "Social", "Otro", "Total",
]
OUTBREAK_REPAIRS = [
    (r"\([A-zÀ-ú, \.]+\)", ""),
    (r", etc.", ""),
    (r", ", "/"),
    (r" y/o ", "/"),
    (r"1 A efectos de notificación .* de un mismo domicilio.", ""),
    (r" (?<=[A-zÀ-ú] )(?=[A-zÀ-ú])", "_"),
]

# Index-page links that lead to reports.
REPORT_HREF = r"QueHacemos/.*\.pdf"
REPORT_TITLE = "informe nº"

# Column names of the vaccination sheets.
VACCINATION_COLUMNS = {
    "Unnamed: 0": "autonomous_region",
    "Dosis entregadas (1)": "received_doses.total",
    "Total Dosis entregadas (1)": "received_doses.total",
    "Dosis entregadas Pfizer (1)": "received_doses.Pfizer",
    "Dosis entregadas Moderna (1)": "received_doses.Moderna",
    "Dosis entregadas AstraZeneca (1)": "received_doses.AstraZeneca",
    "Dosis entregadas Janssen (1)": "received_doses.Janssen",
    "Dosis administradas (2)": "applied_doses",
    "% sobre entregadas": "percentage_applied_doses",
    "Nº Personas con al menos 1 dosis": "number_at_least_single_dose_people",
    "Nº Personas vacunadas(pauta completada)": "number_fully_vaccinated_people",
    "Fecha de la última vacuna registrada (2)": "date",
}
# Percentage columns and the positions dropped per sheet layout.
AGE_BANDS_NEW = {
    "%": "80+", "%.1": "70-79", "%.2": "60-69", "%.3": "50-59",
    "%.4": "40-49", "%.5": "30-39", "%.6": "20-29", "%.7": "12-19",
}
AGE_BANDS_OLD = {
    "%": "80+", "%.1": "70-79", "%.2": "60-69", "%.3": "50-59",
    "%.4": "25-49", "%.5": "18-24", "%.6": "16-17",
}
AGE_BANDS_NEW_MARK = "20-29"
WIDE_SHEET_OVER = 20
WIDE_SHEET_DROPS = [1, 2, 4, 5, 7, 8, 10, 11, 13, 14, 16, 17, 19, 20, 22, 23]
NARROW_SHEET_DROPS = [1, 3, 5, 7, 9, 11, 13, 15, 17, 18, 19]
SHEET_REGION_LABELS = {"Totales": "España", "Total España": "España"}
ARMED_FORCES = "Fuerzas Armadas"


def decade_bands() -> dict[str, str]:
    """Five-year (and infant) age bands to the ten-year bands of the panel."""
    bands = {"0-1": "0-9", "1-4": "0-9"}
    for start in range(0, 80, 5):
        decade = start // 10 * 10
        bands[f"{start}-{start + 4}"] = f"{decade}-{decade + 9}"
    for old in ("80-84", "85-89", "90-94", "95+", "≥90"):
        bands[old] = "80+"
    bands["Total"] = "total"
    return bands


def joined(name: str) -> str:
    """A region name as one word, the way pages are tokenised."""
    return name.replace("-", "_").replace(" ", "_")
