"""Patterns, words and points that results depend on, as plain text."""

# Month names and abbreviations, upper case and without accents.
MONTHS = {
    "ENE": 1, "ENERO": 1, "FEB": 2, "FEBRERO": 2, "MAR": 3, "MARZO": 3, "ABR": 4, "ABRIL": 4,
    "MAY": 5, "MAYO": 5, "JUN": 6, "JUNIO": 6, "JUL": 7, "JULIO": 7, "AGO": 8, "AGOSTO": 8,
    "SEP": 9, "SEPTIEMBRE": 9, "OCT": 10, "OCTUBRE": 10, "NOV": 11, "NOVIEMBRE": 11, "DIC": 12, "DICIEMBRE": 12,
}

# Patterns of typed values in page texts; each has one group, the value.
RFC = r"(?<![A-Z0-9Ñ&])([A-ZÑ&]{3,4}\d{6}\s*[A-Z0-9]{3})(?![A-Z0-9])"
CURP = r"(?<![A-Z0-9])([A-Z]{4}\d{6}[HM][A-Z]{5}[A-Z0-9]{2})(?![A-Z0-9])"
CLABE = r"(?<!\d)(\d{18})(?!\d)"
UUID = r"(?<![A-F0-9])([A-F0-9]{8}-[A-F0-9]{4}-[A-F0-9]{4}-[A-F0-9]{4}-[A-F0-9]{12})(?![A-F0-9])"
MONEY = r"(?<![\d.])(\$[ \t]{0,5}\d[\d,]{0,20}\.\d{2}|\d{1,3}(?:,\d{3})+\.\d{2}|\d{1,12}\.\d{2})(?![\d.])"
DATE = r"(?<!\d)(\d{1,2}[/-]\d{1,2}[/-](?:20\d{2}|\d{2}))(?!\d)"
ACCOUNT = r"(?:CUENTA(?:\s+DE\s+(?:CARGO|ABONO))?|CTA\.?|NO\.?\s*DE\s*CUENTA)\s*(?:NO\.?)?\s*[:#-]?\s*(\d[\d ]{7,22})"
FOLIO = r"(?:FOLIO(?:\s+(?:FISCAL|UNICO|DEL\s+LOTE))?|REFERENCIA|REF\.?)\s*[:#-]?\s*([A-Z0-9][A-Z0-9/_-]{3,45})"

# Labels looked for before an amount, in order of priority.
AMOUNT_LABELS = [
    ("NETO DEL RECIBO", "neto del recibo"),
    ("IMPORTE TOTAL", "importe total"),
    ("CIFRA DE CONTROL", "cifra de control"),
    ("SALDO FINAL", "saldo final"),
    ("TOTAL", "total"),
    ("CANTIDAD", "cantidad"),
    ("DEBE", "debe o haber"),
    ("HABER", "debe o haber"),
]

# Classification rules as (type, where, pattern, points), in order.
CLASS_RULES = [
    ("Cheque", "name", r"(^|\W)CH(?:EQUE)?[- _]", 10),
    ("Cheque", "name", r"CHEQUE", 8),
    ("Cheque", "text", r"\bCHEQUE\b", 3),
    ("Cheque", "text", r"PAGUESE POR ESTE CHEQUE", 5),
    ("Transferencia", "name", r"(^|\W)T[- _]?\d", 10),
    ("Transferencia", "name", r"TRANSFE|TRANFER", 10),
    ("Transferencia", "text", r"TRANSFERENCIA (?:ELECTRONICA|BANCARIA)", 5),
    ("Transferencia", "text", r"\bSPEI\b", 4),
    ("Nómina", "name", r"NOMINA|RECIBOS? DE NOMINA", 10),
    ("Nómina", "text", r"\bNOMINA\b", 4),
    ("Nómina", "text", r"PERCEPCIONES.{0,80}DEDUCCIONES", 5),
    ("Póliza", "name", r"POLIZA", 10),
    ("Póliza", "text", r"\bPOLIZA(?: DE)? (?:EGRESOS|INGRESOS|DIARIO|CHEQUE)\b", 5),
    ("Póliza", "text", r"\bNUMERO DE POLIZA\b", 4),
    ("Balanza de comprobación", "name", r"BALANZA", 10),
    ("Balanza de comprobación", "text", r"BALANZA DE COMPROBACION", 8),
    ("Balanza de comprobación", "text", r"SALDO INICIAL.{0,100}MOVIMIENTOS", 4),
    ("Finiquito", "name", r"FINIQUITO", 10),
    ("Finiquito", "text", r"\bFINIQUITO\b", 6),
    ("Finiquito", "text", r"TERMINACION (?:DE LA )?RELACION LABORAL", 4),
    ("Estado de cuenta", "name", r"ESTADO(?:S)? DE CUENTA", 10),
    ("Estado de cuenta", "name", r"\bEDO\s*CUENTA|\bEDOCTA", 10),
    ("Estado de cuenta", "text", r"ESTADO DE CUENTA", 6),
    ("Estado de cuenta", "text", r"SALDO ANTERIOR.{0,100}SALDO FINAL", 4),
    ("Factura o CFDI", "name", r"FACTURA|CFDI", 8),
    ("Factura o CFDI", "text", r"FOLIO FISCAL", 5),
    ("Factura o CFDI", "text", r"COMPROBANTE FISCAL DIGITAL", 6),
    ("Factura o CFDI", "text", r"\bUUID\b", 3),
    ("Estado analítico del presupuesto", "name", r"ESTADO ANALITICO", 10),
    ("Estado analítico del presupuesto", "text", r"ESTADO ANALITICO.{0,100}EJERCICIO.{0,100}PRESUPUESTO", 8),
    ("Cuenta pública", "name", r"CUENTA PUBLICA", 10),
    ("Cuenta pública", "text", r"\bCUENTA PUBLICA\b", 6),
    ("Expediente de pago especial", "name", r"AGENTES MUNICIPALES", 10),
    ("Expediente de pago especial", "name", r"PAGO DE LAUDO", 10),
    ("Expediente de pago especial", "name", r"PAGO DIA DEL POLICIA", 10),
]
OTHER = "Otros / requiere revisión"

# Words of four letters or more that are no terms.
STOPWORDS = (
    "para como este esta estos estas desde hasta sobre entre donde fecha total pagina municipio ayuntamiento pesos "
    "centavos documento nombre numero cuenta concepto importe haber debe federal mexico veracruz enero febrero marzo "
    "abril mayo junio julio agosto septiembre octubre noviembre diciembre"
).split()

# Words left out of names and of payment concepts.
NAME_STOPWORDS = "MUNICIPIO DE DEL LA EL EMILIANO ZAPATA VER VERACRUZ PERSONAL".split()
CONCEPT_STOPWORDS = "DE DEL EL LA POR PARA MES PAGO NOMINA".split()

# Record types in stage order, and the orders in which a case takes its values from them.
POLICY, CHEQUE, TRANSFER, BANK, PAYROLL = "poliza_orden_pago", "cheque", "lote_transferencia", "movimiento_bancario", "recibo_nomina"
STAGES = [POLICY, CHEQUE, TRANSFER, BANK, PAYROLL]
VALUE_ORDER = [BANK, TRANSFER, CHEQUE, PAYROLL, POLICY]
NAME_ORDER = [PAYROLL, CHEQUE, BANK, POLICY]

# Words that mark a plausible reading, the first group being column headers.
HEADERS = "ayuntamiento municipio poliza póliza pólizas cuenta total fecha debe haber egresos concepto saldo presupuesto comprobación pago".split()
COMMON = HEADERS + "de del la el por con enero febrero pesos veracruz servicios personales finiquito orden pagado ingresos".split()
READING_PATTERNS = [r"\b\d+(?:\.\d+){3,}\b", r"\b[A-Z]{1,6}\d{6,}\b"]
