"""Canonical frames of the engine. Reference ids are positive everywhere; a kind or role column tells references and reads apart."""

from __future__ import annotations

REFS = "ref_id long, chrom string, first_pos long, last_pos long, pattern string, copynum double, is_singleton boolean"
READ_TRS = "read_id long, sid long, ref_id long, left_flank int, right_flank int, copynum double, prof_score double, flank_score double"
READS = "head string, dna string, file_idx int"
PROFILES = "rid long, patlen int, copynum double, proflen int, proflen_rc int, profile array<short>, profile_rc array<short>, n_a int, n_c int, n_g int, n_t int, left_flank string, right_flank string"
SUPPORT = "ref_id long, copies int, same_as_ref int, support long, copies_float double, representative long"
