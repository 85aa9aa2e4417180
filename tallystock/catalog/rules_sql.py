"""DuckDB side of the keyword rules, written out as plain CASE expressions."""

from __future__ import annotations


def _any(column: str, *words: str) -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


_GRANULAR = _any("u", "WG", "DAP", "UREA", "NPK", "YARAMILA", "YARABELA", "YARAVERA", "GRANUPOTASE", "DOLOMAG",
                 "AZUFERTIL", "GRANUMAX", "MOP", "MF ", "NITRO XTEND", "NUTRIMON", "PRODUMON", "ENPALMA", "NITRASAM",
                 "SEMBRAMON", "NUTRICARGA", "CAL DOLOMITA", "CALIX", "TALANTE", "THIAMETOXAN")
_SOLUBLE = _any("u", "WP", "WS", "SOLU", "MAP", "MKP", "CALCINIT", "NITRABOR", "MAGNISOL", "MICROCOMBO", "MICRO FE",
                "FERTI K", "FERTI MAG", "METARIL", "BAUBASIL", "BAUBASSIL", "MICORRIZOL", "TRICHO", "ENZUP PDS",
                "MIKROTHOR", "H2O PLUS", "GR5")
_SUBSTRATE = _any("u", "SUSTRATO", "COCO MIX", "TURBA", "PERLITAS", "BOLSA DE CRECIMIENTO", "70/30", "SC18L", "SC12L",
                  "ESSE SC")
_GREENHOUSE = _any("u", "JIFFY", "CANALETA", "SARAN", "MULCH", "GROUND COVER", "MANTA AGRICOLA", "SPACER", "MACETA",
                   "BANDEJA", "PELLET")
CATEGORY = f"""CASE upper(trim(categoria_raw))
  WHEN 'GRANULAR - SOLUBLES' THEN CASE WHEN {_GRANULAR} THEN 'Granular' WHEN {_SOLUBLE} THEN 'Soluble'
    WHEN {_any('u', 'POEMA', 'GATOS', 'PERROS')} THEN 'Otros' ELSE 'Granular - Solubles' END
  WHEN 'MATERIAL PARA INVERNADEROS - SUSTRATO Y OTROS' THEN CASE WHEN {_SUBSTRATE} THEN 'Sustrato'
    WHEN {_GREENHOUSE} THEN 'Material para Invernaderos' ELSE 'Otros' END
  ELSE categoria_raw END"""
BRAND = f"""CASE WHEN starts_with(upper(trim(codigo_producto)), 'ABP') THEN 'ABP'
  WHEN starts_with(trim(u), 'BIO ') OR starts_with(trim(u), 'BIO -') THEN 'Biovenko'
  WHEN {_any('u', 'ABP -', 'ABP-')} THEN 'ABP' WHEN {_any('u', 'BRANDT')} THEN 'Brandt'
  WHEN {_any('u', 'FERTILISA')} THEN 'Fertilisa' WHEN {_any('u', 'JIFFY')} THEN 'Jiffy'
  WHEN {_any('u', 'MANVERT')} THEN 'Manvert' WHEN {_any('u', 'MANTTRA')} THEN 'Manttra'
  WHEN {_any('u', 'MF ')} THEN 'MF (Mosaic Fertilizantes)' WHEN {_any('u', 'NORDOX')} THEN 'Nordox'
  WHEN {_any('u', 'NUTRIMON', 'MONOMEROS')} THEN 'Monomeros' WHEN {_any('u', 'OPISTRA')} THEN 'Opistra'
  WHEN {_any('u', 'QUIVER')} THEN 'Quiver' WHEN {_any('u', 'YARA')} THEN 'Yara' WHEN {_any('u', 'POEMA')} THEN 'POEMA'
  WHEN {_any('u', 'GRANUPOTASE')} THEN 'Haifa' ELSE 'Desconocido' END"""
UNIT = f"""CASE WHEN {_any('u', ' GRAMOS', ' 250 G', ' 500 G', ' 100 G', ' G)')} THEN 'G' WHEN {_any('u', 'KG')} THEN 'Kg'
  WHEN {_any('u', ' GALON', ' GAL ', ' 2.5 GAL')} THEN 'Gal'
  WHEN {_any('u', ' LT', ' 20L', ' 10L', ' 5 L', 'SC18L', 'SC12L')} THEN 'Lt' WHEN {_any('u', 'CJ')} THEN 'CJ'
  WHEN {_any('u', 'ROLLO', 'SARAN', 'GROUND COVER', 'MULCH', 'MANTA AGRICOLA')} THEN 'Ro' ELSE 'Un' END"""
PRESENTATION = r"""coalesce(nullif(regexp_extract(u, 'CJ[0-9]+'), ''),
  nullif(regexp_extract(u, '[0-9]+([.,][0-9]+)?\s*(KG|KGS|LT|LTS|G|GRAMOS|LB)'), ''),
  nullif(regexp_extract(u, '[0-9]+([.,][0-9]+)?M'), ''))"""
REVIEW = """CASE WHEN upper(trim(categoria_jerarquizada)) IN ('SOLUBLE', 'GRANULAR', 'LIQUIDOS',
  'MATERIAL PARA INVERNADEROS', 'SUSTRATO', 'OTROS') THEN 'OK' ELSE 'REVISAR' END"""

# Needs inv_product; gives one classified row per product.
CLASSIFIED = f"""upped AS (SELECT id_producto, codigo_producto, nombre, categoria_raw, upper(nombre) AS u FROM inv_product),
classified AS (SELECT id_producto, codigo_producto, nombre, categoria_raw, {CATEGORY} AS categoria_jerarquizada,
  {BRAND} AS marca, {UNIT} AS unidad, {PRESENTATION} AS presentacion FROM upped)"""
