"""Literal study tables for the golden tests.

Fixed values: the small staff, sales and department tables of the study
material, and its product batches; expected results are listed in
FIXTURES.md (G0-G12).
"""

import datetime as dt

STAFF_COLUMNS = ["id", "nome", "departamento", "salario", "data_contratacao", "dept_id"]
STAFF = [
    (1, "João", "Vendas", 5000.0, "2023-01-15", 1),
    (2, "Maria", "TI", 7500.0, "2022-06-20", 2),
    (3, "Pedro", "Vendas", 4500.0, "2023-03-10", 1),
    (4, "Ana", "RH", 6000.0, "2021-11-05", 3),
    (5, "Carlos", "TI", 8000.0, "2020-08-22", 2),
    (6, "Julia", "TI", 6500.0, "2023-07-01", 2),
]

SALES_COLUMNS = ["venda_id", "funcionario_id", "valor", "data_venda"]
SALES = [
    (1, 1, 10000.0, "2024-01-15"),
    (2, 1, 15000.0, "2024-02-20"),
    (3, 3, 8000.0, "2024-01-25"),
    (4, 1, 12000.0, "2024-03-10"),
    (5, 3, 9500.0, "2024-02-28"),
]

DEPT_COLUMNS = ["dept_id", "nome_dept", "cidade"]
DEPTS = [
    (1, "Vendas", "São Paulo"),
    (2, "TI", "Rio de Janeiro"),
    (3, "RH", "Belo Horizonte"),
]

PRODUCT_COLUMNS = ["id", "produto", "categoria", "quantidade", "preco_unitario", "data_venda", "regiao"]
PRODUCTS_FIRST = [
    (1, "Notebook", "Computadores", 10, 3500.0, dt.date(2024, 1, 15), "Sul"),
    (2, "Mouse", "Periféricos", 50, 150.0, dt.date(2024, 1, 20), "Sudeste"),
    (3, "Teclado", "Periféricos", 30, 300.0, dt.date(2024, 2, 10), "Sul"),
    (4, "Monitor", "Computadores", 15, 1200.0, dt.date(2024, 2, 15), "Norte"),
    (5, "Webcam", "Periféricos", 25, 400.0, dt.date(2024, 3, 1), "Sudeste"),
]
PRODUCTS_SECOND = [
    (6, "Headset", "Periféricos", 40, 250.0, dt.date(2024, 3, 15), "Sul"),
    (7, "SSD", "Armazenamento", 20, 500.0, dt.date(2024, 3, 20), "Sudeste"),
]
