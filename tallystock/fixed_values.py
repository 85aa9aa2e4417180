"""Names, codes, lists and seed rows the results depend on.

Everything here is data. The order of rows and of list items is meaningful where
"first hit wins" applies.
"""

# What str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Sheet-name aliases -> kind of table; the first alias found in a workbook wins.
SHEET_ALIASES = [
    ("Fertilisa", "principal"),
    ("Manvert, Jiffy", "lotes"),
    ("Manvert,Jiffy", "lotes"),
    ("Manvert Jiffy", "lotes"),
    ("LISTA DE PRODUCTOS", "catalogo"),
    ("EJEMPLO DATOS KARDEX", "movimientos"),
]

# Section titles as typed in the sheet (trimmed, lower case) -> category name.
SECTION_NAMES = {
    "granular - solubles": "Granular - Solubles",
    "granular-solubles": "Granular - Solubles",
    "liquidos": "Liquidos",
    "líquidos": "Liquidos",
    "material para invernaderos - sustrato y otros": "Material para Invernaderos - Sustrato y Otros",
    "material para invernaderos": "Material para Invernaderos - Sustrato y Otros",
}

HEADER_WORDS = ["codigo", "código", "cod", "code", "tipo"]

MOVEMENT_TYPES = [
    "Entrada Inventario-SI",
    "Salida Inventario-SI",
    "Toma Física",
    "Venta-CONSUMIDOR FINAL-SI",
    "Venta-NOTA DE CRÉDITO FISOFT-SI",
    "Entrada",
]

DATE_NULL_TOKENS = ["N/A", "NA", "NONE"]
CELL_NULL_TOKENS = ["N/A", "NA", ""]

# Inflow quantities treated as noise by the ageing light.
NOISE_QUANTITIES = ["1", "2", "2.5", "3", "4", "5"]

# Ageing light: id, colour, range, upper bound in days (None = open).
LIGHTS = [
    (1, "Verde", "Hasta 90 días"),
    (2, "Amarillo", "De 91 a 365 días"),
    (3, "Rojo", "Más de 365 días"),
    (4, "Revisión", "Sin entrada"),
]
GREEN_DAYS = 90
YELLOW_DAYS = 365

MONTH_NAMES = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto",
               "Septiembre", "Octubre", "Noviembre", "Diciembre"]
WEEKDAY_NAMES = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]
HOLIDAYS = {
    "01-01": "Año Nuevo",
    "04-11": "Día de Juan Santamaría",
    "05-01": "Día del Trabajo",
    "07-25": "Anexión del Partido de Nicoya",
    "08-02": "Virgen de los Ángeles",
    "08-15": "Día de la Madre",
    "09-15": "Día de la Independencia",
    "10-12": "Día de las Culturas",
    "12-25": "Navidad",
}

UNKNOWN_BRAND = "SIN_MARCA"
UNKNOWN_CATEGORY = "ND"
UNKNOWN_PRODUCT = "SIN_PRODUCTO"
UNKNOWN_KEY = -1
OPEN_END = "9999-12-31"

# nk_marca (= nombre_marca), pais_origen, tipo_proveedor
BRAND_SEED = [
    ("Fertilisa", "Costa Rica", "Nacional"),
    ("Manvert", "España", "Importado"),
    ("Jiffy", "Noruega", "Importado"),
    ("ABP", "Costa Rica", "Nacional"),
    ("BioControl", "Costa Rica", "Nacional"),
    ("Opistra", "Costa Rica", "Nacional"),
    ("Manttra", "Costa Rica", "Nacional"),
    ("YaraBela", "Noruega", "Importado"),
    ("Brandt", "Estados Unidos", "Importado"),
    ("QTS", "Desconocido", "Desconocido"),
    ("GranuPotasse", "Francia", "Importado"),
    ("DAP", "Desconocido", "Importado"),
    ("Material Agrícola", "Desconocido", "Desconocido"),
    ("Poema", "Desconocido", "Desconocido"),
    ("Agrotecnica", "Costa Rica", "Nacional"),
    ("Otros", "Desconocido", "Desconocido"),
]

# nk_categoria, nombre_categoria, tipo_producto
CATEGORY_SEED = [
    ("GS", "Granular - Solubles", "Granular"),
    ("LQ", "Liquidos", "Líquido"),
    ("MI", "Material para Invernaderos - Sustrato y Otros", "Sustrato-Material"),
]

# nombre -> codigo, tipo, descripcion
CATEGORY_RECODE = {
    "Soluble": ("SO", "Solubles", "Productos fertilizantes solubles."),
    "Granular": ("GR", "Granulares", "Productos fertilizantes granulares."),
    "Otros": ("OT", "Varios", "Productos que no pertenecen a una categoría específica."),
    "Liquidos": ("LI", "Liquido", "Fertilizantes, bioestimulantes y productos líquidos."),
    "Material para Invernaderos": (
        "MI", "Materiales", "Materiales para invernaderos, coberturas, bandejas y accesorios."),
    "Sustrato": ("SU", "Sustratos", "Sustratos y medios de crecimiento para cultivos."),
}
UNDEFINED_CATEGORY = "Sin Categoría"
UNDEFINED_CATEGORY_TEXT = "Categoría no definida o no identificada."

# sk, nk_estado, nombre_estado, descripcion, es_disponible, requiere_accion, color_semaforo
STOCK_STATES = [
    (1, "DISP_OK", "Disponible — Sin Discrepancia", "Stock físico mayor a cero y coincide exactamente con el sistema.", True, False, "Verde"),
    (2, "DISP_FALT", "Disponible — Faltante",
     "Hay stock físico pero el sistema registra más. Posible pérdida no justificada.", True, True, "Amarillo"),
    (3, "DISP_SOBRANTE", "Disponible — Sobrante",
     "Hay stock físico pero el sistema registra menos. Posible ingreso no registrado.", True, True, "Amarillo"),
    (4, "SIN_STOCK", "Sin Stock", "Inventario físico y sistema ambos en cero. Producto agotado.", False, False, "Gris"),
    (5, "AGOTADO_DESAC", "Agotado — Sistema Desactualizado",
     "Físico en cero pero el sistema dice que hay existencia. Discrepancia crítica.", False, True, "Rojo"),
    (6, "PEND_REVISION", "Pendiente de Revisión",
     "Estado indeterminado. Requiere segundo conteo o verificación documental.", False, True, "Rojo"),
]

# sk, nk_tipo_disc, nombre_tipo, descripcion, impacto_financiero, afecta_activos, accion_recomendada
DISCREPANCY_TYPES = [
    (1, "PR", "Pendiente Rebajar", "Movimiento físico realizado (salida) pero no registrado en el sistema David.", "Alto", True,
     "Ejecutar la transacción de salida en Sistema David."),
    (2, "EP", "Entrega Pendiente", "Producto físicamente recibido en bodega pero no ingresado al sistema.", "Medio", True,
     "Registrar el ingreso de mercancía en el sistema."),
    (3, "FF", "Faltante Físico", "Menos unidades físicas que lo registrado en el sistema sin explicación.", "Alto", True,
     "Investigar causa (robo/merma/error). Ajuste negativo autorizado por gerencia."),
    (4, "SNR", "Sobrante No Registrado", "Más unidades físicas que lo registrado en el sistema. Activo no contabilizado.", "Alto", True,
     "Registrar el ingreso al sistema con costo correspondiente."),
    (5, "SCN", "Sobrante Con Nota", "Sobrante con observación que explica parcialmente la diferencia.", "Medio", False,
     "Revisar la observación y ajustar o documentar según corresponda."),
    (6, "FCN", "Faltante Con Nota", "Faltante con observación que explica parcialmente la diferencia.", "Medio", True,
     "Revisar la observación y gestionar ajuste autorizado."),
    (7, "SSJ", "Sobrante Sin Justificar", "Sobrante sin observación. Requiere investigación antes de ajustar.", "Bajo", False,
     "Realizar segundo conteo y documentar hallazgo."),
    (8, "FSJ", "Faltante Sin Justificar", "Faltante sin observación. Requiere investigación antes de ajustar.", "Bajo", True,
     "Realizar segundo conteo y documentar hallazgo."),
    (9, "ND", "Sin Discrepancia", "No hay diferencia entre el conteo físico y el sistema.", "Bajo", False,
     "Sin acción requerida. Inventario exacto."),
]

LOAD_PROCESSES = [
    "ETL_DIM_TIEMPO",
    "ETL_DIM_MARCA",
    "ETL_DIM_CATEGORIA",
    "ETL_DIM_PRODUCTO",
    "ETL_DIM_ESTADO_STOCK",
    "ETL_DIM_TIPO_DISCREPANCIA",
    "ETL_FACT_INVENTARIO",
    "ETL_FACT_DISCREPANCIA",
]

# Keyword rules, tried in this order on the upper-case product name.
SECTION_GRANULAR = "GRANULAR - SOLUBLES"
SECTION_GREENHOUSE = "MATERIAL PARA INVERNADEROS - SUSTRATO Y OTROS"
CATEGORY_RULES = {
    SECTION_GRANULAR: (
        [
            ("Granular", [
                "WG", "DAP", "UREA", "NPK", "YARAMILA", "YARABELA", "YARAVERA", "GRANUPOTASE",
                "DOLOMAG", "AZUFERTIL", "GRANUMAX", "MOP", "MF ", "NITRO XTEND", "NUTRIMON",
                "PRODUMON", "ENPALMA", "NITRASAM", "SEMBRAMON", "NUTRICARGA", "CAL DOLOMITA",
                "CALIX", "CALIX PURE", "TALANTE", "THIAMETOXAN"]),
            ("Soluble", [
                "WP", "WS", "SOLU", "MAP", "MKP", "CALCINIT", "NITRABOR", "MAGNISOL", "MICROCOMBO",
                "MICRO FE", "FERTI K", "FERTI MAG", "METARIL", "BAUBASIL", "BAUBASSIL", "MICORRIZOL",
                "TRICHO", "ENZUP PDS", "MIKROTHOR", "H2O PLUS", "MANVERT H2O", "GR5"]),
            ("Otros", ["POEMA", "GATOS", "PERROS"]),
        ],
        "Granular - Solubles",
    ),
    SECTION_GREENHOUSE: (
        [
            ("Sustrato", [
                "SUSTRATO", "COCO MIX", "TURBA", "PERLITAS", "BOLSA DE CRECIMIENTO", "70/30",
                "SC18L", "SC12L", "ESSE SC"]),
            ("Material para Invernaderos", [
                "JIFFY", "CANALETA", "SARAN", "MULCH", "GROUND COVER", "MANTA AGRICOLA", "SPACER",
                "MACETA", "BANDEJA", "PELLET"]),
        ],
        "Otros",
    ),
}
REVIEWED_CATEGORIES = ["SOLUBLE", "GRANULAR", "LIQUIDOS", "MATERIAL PARA INVERNADEROS", "SUSTRATO", "OTROS"]

# brand, test (code_starts | name_starts | contains), words
BRAND_RULES = [
    ("ABP", "code_starts", ["ABP"]),
    ("Biovenko", "name_starts", ["BIO ", "BIO -"]),
    ("ABP", "contains", ["ABP -", "ABP-"]),
    ("Brandt", "contains", ["BRANDT"]),
    ("Fertilisa", "contains", ["FERTILISA"]),
    ("Jiffy", "contains", ["JIFFY"]),
    ("Manvert", "contains", ["MANVERT"]),
    ("Manttra", "contains", ["MANTTRA"]),
    ("MF (Mosaic Fertilizantes)", "contains", ["MF "]),
    ("Nordox", "contains", ["NORDOX"]),
    ("Monomeros", "contains", ["NUTRIMON", "MONOMEROS"]),
    ("Opistra", "contains", ["OPISTRA"]),
    ("Quiver", "contains", ["QUIVER"]),
    ("Yara", "contains", ["YARAMILA", "YARALIVA", "YARATERA", "YARAVERA", "YARABELA", "YARA"]),
    ("POEMA", "contains", ["POEMA"]),
    ("Haifa", "contains", ["GRANUPOTASE"]),
]
BRAND_DEFAULT = "Desconocido"

UNIT_RULES = [
    ("G", [" GRAMOS", " 250 G", " 500 G", " 100 G", " G)"]),
    ("Kg", [" KG", "KG", " KGS"]),
    ("Gal", [" GALON", " GAL ", " GALONES", " 2.5 GAL"]),
    ("Lt", [" LT", " LTS", " 20L", " 10L", " 5 L", " 1 LT", "SC18L", "SC12L"]),
    ("CJ", ["CJ"]),
    ("Ro", ["ROLLO", "SARAN", "GROUND COVER", "MULCH", "MANTA AGRICOLA"]),
]
UNIT_DEFAULT = "Un"

# Presentation: first pattern that hits gives the text of its first match.
PRESENTATION_PATTERNS = [
    r"CJ\d+",
    r"\d+([.,]\d+)?\s*(KG|KGS|LT|LTS|G|GRAMOS|LB)",
    r"\d+([.,]\d+)?M",
]

# Names of data-quality rules written by the cleaning step.
RULE_NO_CODE = "ERROR RV-01"
RULE_NEGATIVE = "ERROR RV-03:"
RULE_NO_NAME = "WARNING RV-02"
RULE_NO_SYSTEM = "WARNING RV-04"
RULE_MISMATCH = "WARNING RV-05"
RULE_OK = "OK"
