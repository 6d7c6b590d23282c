"""Encryption and content hashes; keys are parameters, never constants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def encrypt_text(text: Column, key: Column) -> Column:
    """Authenticated encryption (AES-GCM) to a base64 text."""
    return F.base64(F.aes_encrypt(text, key, F.lit("GCM"), F.lit("DEFAULT")))


def decrypt_text(token: Column, key: Column) -> Column:
    """Inverse of :func:`encrypt_text`; a tampered token fails the task."""
    return F.aes_decrypt(F.unbase64(token), key, F.lit("GCM"), F.lit("DEFAULT")).cast("string")


def encrypt_bytes(content: Column, key: Column) -> Column:
    """AES-CBC with PKCS padding over a whole file."""
    return F.aes_encrypt(content, key, F.lit("CBC"), F.lit("PKCS"))


def decrypt_bytes(content: Column, key: Column) -> Column:
    """Inverse of :func:`encrypt_bytes`."""
    return F.aes_decrypt(content, key, F.lit("CBC"), F.lit("PKCS"))


def sha256_hex(content: Column) -> Column:
    """SHA-256 of the whole content as hexadecimal text."""
    return F.sha2(content, 256)


def md5_hex(content: Column) -> Column:
    """MD5 of the whole content as hexadecimal text."""
    return F.md5(content)
