"""Layouts of the raw files. They carry no header, so the order of the columns is the file's."""

from __future__ import annotations

# Column names, order and types of the registry's files.
ESTABLISHMENTS = """
    `CNPJ BASICO` bigint, `CNPJ ORDEM` smallint, `CNPJ DV` smallint, `IDENTIFICADOR MATRIZ FILIAL` smallint,
    `NOME FANTASIA` string, `SIT CADASTRAL` smallint, `DATA SIT CADASTRAL` string, `MOTIVO` smallint,
    `CIDADE EXTERIOR` smallint, `CODIGO_PAIS` smallint, `INICIO ATIVIDADE` string, `CNAE PRINCIPAL` string,
    `CNAE SEGUNDARIO` string, `TIPO LOGRADOURO` string, `LOGRADOURO` string, `NUMERO` smallint,
    `COMPLEMENTO` string, `BAIRRO` string, `CEP` bigint, `UF` string, `CODIGO_MUNICIPIO` smallint,
    `DDD` smallint, `TELEFONE` bigint, `DDD2` smallint, `TELEFONE2` double, `DDD FAX` smallint, `FAX` string,
    `EMAIL` string, `SIT FISCAL` string, `DATA SIT FISCAL` date
"""
COMPANIES = """
    `CNPJ BASICO` bigint, `RAZAO SOCIAL` string, `COD NATUREZA JURIDICA` smallint,
    `COD QUALIFICACAO SOCIO` smallint, `CAPITAL SOCIAL` string, `COD PORTE DA EMPRESA` smallint
"""
PARTNERS = """
    `CNPJ BASICO` bigint, `ID DO SOCIO` smallint, `NOME SOCIO` string, `CNPJ/CPF DO SOCIO` string,
    `COD QUALIFICACAO SOCIO` smallint, `DT ENTRADA NA SOCIEDADE` string, `CODIGO PAIS` smallint,
    `REPRESENTANTE LEGAL` string, `NOME REPRESENTANTE` string,
    `QUALIFICAÇÃO DO REPRESENTANTE LEGAL` smallint, `COD FAIXA ETARIA` smallint
"""
REGIME = """
    `CNPJ BASICO` bigint, `OPCAO PELO MEI` string, `DATA DE OPCAO PELO MEI` string,
    `DATA DE EXCLUSAO DO MEI` string
"""
QUALIFICATIONS = "`COD QUALIFICACAO SOCIO` smallint, `QUALIFICACAO DO SOCIO` string"
LEGAL_NATURES = "`COD NATUREZA JURIDICA` smallint, `NATUREZA JURIDICA` string"
COUNTRIES = "`CODIGO_PAIS` smallint, `PAIS` string"
CITIES = "`CODIGO_MUNICIPIO` smallint, `MUNICIPIO` string"
ACTIVITIES = "`CNAE PRINCIPAL` string, `DESCRICAO` string, `COD SETOR` string, `SETOR` string"
