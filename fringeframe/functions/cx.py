"""Complex arithmetic on pairs of Columns; no user-defined type is needed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Cx:
    """A complex-valued expression."""

    re: Column
    im: Column

    @staticmethod
    def of(re, im) -> "Cx":
        to_col = lambda x: F.col(x) if isinstance(x, str) else (x if isinstance(x, Column) else F.lit(float(x)))
        return Cx(to_col(re), to_col(im))

    @staticmethod
    def unit(phase: Column) -> "Cx":
        """exp(i * phase)"""
        return Cx(F.cos(phase), F.sin(phase))

    def __add__(self, o: "Cx") -> "Cx":
        return Cx(self.re + o.re, self.im + o.im)

    def __sub__(self, o: "Cx") -> "Cx":
        return Cx(self.re - o.re, self.im - o.im)

    def __mul__(self, o) -> "Cx":
        if isinstance(o, Cx):
            return Cx(self.re * o.re - self.im * o.im, self.re * o.im + self.im * o.re)
        return Cx(self.re * o, self.im * o)

    def __truediv__(self, o) -> "Cx":
        """Null where the divisor is zero, also under ANSI mode."""
        if isinstance(o, Cx):
            n = self * o.conj()
            d = o.norm()
            return Cx(F.try_divide(n.re, d), F.try_divide(n.im, d))
        return Cx(F.try_divide(self.re, o), F.try_divide(self.im, o))

    def conj(self) -> "Cx":
        return Cx(self.re, -self.im)

    def norm(self) -> Column:
        return self.re * self.re + self.im * self.im

    def abs(self) -> Column:
        return F.sqrt(self.norm())

    def arg(self) -> Column:
        return F.atan2(self.im, self.re)
