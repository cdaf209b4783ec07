"""Map projections of the ellipsoid as Column expressions, both ways: conic equal-area (Albers), polar stereographic, transverse Mercator.

Longitudes and latitudes are in degrees, x and y in metres from the projection's origin. The formulas are the published ones (J. P. Snyder, Map Projections: A
Working Manual, 1987; for the transverse Mercator the series of Krüger to the sixth order, C. F. F. Karney, 2011). Latitudes are found from
authalic and conformal ones by a fixed number of Newton steps, so that expressions need no loop over data. Null gives null.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.operators.spatial import _let

STEPS = 5


@dataclass(frozen=True)
class Ellipsoid:
    a: float
    inverse_flattening: float

    @property
    def e2(self) -> float:
        f = 1 / self.inverse_flattening if self.inverse_flattening else 0.0
        return f * (2 - f)


# Half axes in metres and inverse flattenings.
GRS80 = Ellipsoid(6378137.0, 298.257222101)
WGS84 = Ellipsoid(6378137.0, 298.257223563)


def _turned(lon: Column, origin: float) -> Column:
    """Radians east of an origin, from -pi up to pi."""
    d = lon - origin
    return F.radians(d - 360 * F.floor((d + 180) / 360))


def _degrees(radians: Column, origin: float) -> Column:
    d = F.degrees(radians) + origin
    return d - 360 * F.floor((d + 180) / 360)


def _q(sine, e2: float, log=F.log):
    """The authalic function of the sine of a latitude."""
    if e2 == 0:
        return 2 * sine
    e = math.sqrt(e2)
    return (1 - e2) * (sine / (1 - e2 * sine * sine) - log((1 - e * sine) / (1 + e * sine)) / (2 * e))


@dataclass(frozen=True)
class Albers:
    """Conic equal-area with two standard parallels."""

    lat1: float
    lat2: float
    lat0: float
    lon0: float
    ellipsoid: Ellipsoid = GRS80

    def _constants(self) -> tuple[float, float, float]:
        """n, c and the radius at the origin."""
        e2 = self.ellipsoid.e2
        s0, s1, s2 = (math.sin(math.radians(v)) for v in (self.lat0, self.lat1, self.lat2))
        m = lambda s: math.sqrt((1 - s * s) / (1 - e2 * s * s))
        q = lambda s: _q(s, e2, math.log)
        n = s1 if self.lat1 == self.lat2 else (m(s1) ** 2 - m(s2) ** 2) / (q(s2) - q(s1))
        c = m(s1) ** 2 + n * q(s1)
        return n, c, self.ellipsoid.a * math.sqrt(c - n * q(s0)) / n

    def forward(self, lon: Column, lat: Column, wrapped: bool = True) -> Column:
        """Struct x, y. Unless wrapped, longitudes run on past the cut opposite the origin and keep their place on the cone unrolled."""
        n, c, rho0 = self._constants()
        rho = self.ellipsoid.a * F.sqrt(F.greatest(c - n * _q(F.sin(F.radians(lat)), self.ellipsoid.e2), F.lit(0.0))) / n
        theta = n * (_turned(lon, self.lon0) if wrapped else F.radians(lon - self.lon0))
        return F.struct((rho * F.sin(theta)).alias("x"), (rho0 - rho * F.cos(theta)).alias("y"))

    def inverse(self, x: Column, y: Column, half_turn: Column | None = None) -> Column:
        """Struct lon, lat; null for what lies beyond a pole.

        Latitudes that run on past a pole fall on those of the same sine: half_turn, 0 from -90 to 90, 1 up to 270 and so on, says which is meant.
        """
        n, c, rho0 = self._constants()
        e2, sign = self.ellipsoid.e2, math.copysign(1, n)
        away = rho0 - y
        q = (c - (x * x + away * away) * n * n / self.ellipsoid.a**2) / n
        top = _q(1.0, e2, math.log)

        def better(phi: Column) -> Column:
            s = F.sin(phi)
            w = 1 - e2 * s * s
            return phi + w * w / (2 * F.cos(phi)) * (q - _q(s, e2)) / (1 - e2)

        # From the authalic latitude, which is right at the poles: steps from elsewhere only halve what is left there.
        phi = F.asin(F.greatest(F.lit(-1.0), F.least(q / top, F.lit(1.0))))
        for _ in range(STEPS):
            phi = _let(phi, better)
        lat = F.when(F.abs(q) > top * (1 + 1e-12), F.lit(None)).when(F.abs(q) >= top * (1 - 1e-12), F.signum(q) * 90.0).otherwise(F.degrees(phi))
        if half_turn is not None:
            lat = half_turn * 180 + F.when(half_turn % 2 == 0, lat).otherwise(-lat)
        return F.struct(_degrees(F.atan2(sign * x, sign * away) / n, self.lon0).alias("lon"), lat.alias("lat"))


@dataclass(frozen=True)
class PolarStereographic:
    """True to scale at a parallel of its hemisphere."""

    true_lat: float
    lon0: float
    ellipsoid: Ellipsoid = WGS84

    def _scale(self) -> float:
        """Metres of radius for a unit of t."""
        e2, s = self.ellipsoid.e2, math.sin(math.radians(abs(self.true_lat)))
        e = math.sqrt(e2)
        if abs(self.true_lat) == 90:
            return 2 * self.ellipsoid.a / math.sqrt((1 + e) ** (1 + e) * (1 - e) ** (1 - e))
        t = math.tan(math.pi / 4 - math.radians(abs(self.true_lat)) / 2) / ((1 - e * s) / (1 + e * s)) ** (e / 2)
        return self.ellipsoid.a * math.sqrt((1 - s * s) / (1 - e2 * s * s)) / t

    def forward(self, lon: Column, lat: Column) -> Column:
        side, e = math.copysign(1, self.true_lat), math.sqrt(self.ellipsoid.e2)
        phi = F.radians(lat) * side
        s = e * F.sin(phi)
        rho = self._scale() * F.tan(math.pi / 4 - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(e / 2))
        theta = _turned(lon, self.lon0)
        return F.struct((rho * F.sin(theta)).alias("x"), (-side * rho * F.cos(theta)).alias("y"))

    def inverse(self, x: Column, y: Column) -> Column:
        side, e = math.copysign(1, self.true_lat), math.sqrt(self.ellipsoid.e2)
        t = F.sqrt(x * x + y * y) / self._scale()

        def better(phi: Column) -> Column:
            s = e * F.sin(phi)
            return math.pi / 2 - 2 * F.atan(t * F.pow((1 - s) / (1 + s), F.lit(e / 2)))

        phi = math.pi / 2 - 2 * F.atan(t)
        for _ in range(2 * STEPS):
            phi = _let(phi, better)
        return F.struct(_degrees(F.atan2(x, -side * y), self.lon0).alias("lon"), (F.degrees(phi) * side).alias("lat"))


@dataclass(frozen=True)
class TransverseMercator:
    lon0: float
    scale: float = 0.9996
    false_x: float = 500_000.0
    false_y: float = 0.0
    ellipsoid: Ellipsoid = WGS84

    def _series(self) -> tuple[float, list[float], list[float]]:
        """The rectifying radius, and the coefficients there and back, by the third flattening."""
        f = 1 / self.ellipsoid.inverse_flattening
        n = f / (2 - f)
        # The published rational coefficients of the powers of n, from the power equal to the row's number on.
        there = [[1 / 2, -2 / 3, 5 / 16, 41 / 180, -127 / 288, 7891 / 37800], [13 / 48, -3 / 5, 557 / 1440, 281 / 630, -1983433 / 1935360], [61 / 240, -103 / 140, 15061 / 26880, 167603 / 181440], [49561 / 161280, -179 / 168, 6601661 / 7257600], [34729 / 80640, -3418889 / 1995840], [212378941 / 319334400]]
        back = [[1 / 2, -2 / 3, 37 / 96, -1 / 360, -81 / 512, 96199 / 604800], [1 / 48, 1 / 15, -437 / 1440, 46 / 105, -1118711 / 3870720], [17 / 480, -37 / 840, -209 / 4480, 5569 / 90720], [4397 / 161280, -11 / 504, -830251 / 7257600], [4583 / 161280, -108847 / 3991680], [20648693 / 638668800]]
        sums = lambda rows: [sum(c * n ** (k + 1 + i) for i, c in enumerate(row)) for k, row in enumerate(rows)]
        radius = self.ellipsoid.a / (1 + n) * (1 + n**2 / 4 + n**4 / 64 + n**6 / 256)
        return radius * self.scale, sums(there), sums(back)

    def forward(self, lon: Column, lat: Column) -> Column:
        radius, there, _ = self._series()
        e = math.sqrt(self.ellipsoid.e2)
        s = F.sin(F.radians(lat))
        conformal = F.sinh(F.atanh(s) - e * F.atanh(e * s))
        d = _turned(lon, self.lon0)

        def placed(t: Column) -> Column:
            xi, eta = F.atan2(t, F.cos(d)), F.asinh(F.sin(d) / F.sqrt(t * t + F.cos(d) * F.cos(d)))
            return _let(F.struct(xi.alias("xi"), eta.alias("eta")), at)

        def at(p: Column) -> Column:
            x, y = p["eta"], p["xi"]
            for k, c in enumerate(there, 1):
                x = x + c * F.cos(2 * k * p["xi"]) * F.sinh(2 * k * p["eta"])
                y = y + c * F.sin(2 * k * p["xi"]) * F.cosh(2 * k * p["eta"])
            return F.struct((self.false_x + radius * x).alias("x"), (self.false_y + radius * y).alias("y"))

        return _let(conformal, placed)

    def inverse(self, x: Column, y: Column) -> Column:
        radius, _, back = self._series()
        e2 = self.ellipsoid.e2
        e = math.sqrt(e2)

        def at(p: Column) -> Column:
            eta, xi = p["eta"], p["xi"]
            for k, c in enumerate(back, 1):
                eta = eta - c * F.cos(2 * k * p["xi"]) * F.sinh(2 * k * p["eta"])
                xi = xi - c * F.sin(2 * k * p["xi"]) * F.cosh(2 * k * p["eta"])
            return _let(F.struct(xi.alias("xi"), eta.alias("eta")), placed)

        def placed(p: Column) -> Column:
            t = F.sin(p["xi"]) / F.sqrt(F.sinh(p["eta"]) ** 2 + F.cos(p["xi"]) ** 2)

            def better(tau: Column) -> Column:
                """A Newton step for the tangent of the latitude whose conformal tangent is t."""
                s = F.sinh(e * F.atanh(e * tau / F.sqrt(1 + tau * tau)))
                got = tau * F.sqrt(1 + s * s) - s * F.sqrt(1 + tau * tau)
                return tau + (t - got) / F.sqrt(1 + got * got) * (1 + (1 - e2) * tau * tau) / ((1 - e2) * F.sqrt(1 + tau * tau))

            tau = t
            for _ in range(STEPS):
                tau = _let(tau, better)
            return F.struct(_degrees(F.atan2(F.sinh(p["eta"]), F.cos(p["xi"])), self.lon0).alias("lon"), F.degrees(F.atan(tau)).alias("lat"))

        return _let(F.struct(((y - self.false_y) / radius).alias("xi"), ((x - self.false_x) / radius).alias("eta")), at)


# The projections of the regions' maps, by their registry numbers where they have one.
BY_CODE = {
    5070: Albers(29.5, 45.5, 23.0, -96.0),
    3338: Albers(55.0, 65.0, 50.0, -154.0),
    3031: PolarStereographic(-71.0, 0.0),
    3995: PolarStereographic(71.0, 0.0),
    32655: TransverseMercator(147.0),
    32619: TransverseMercator(-69.0),
}
#: Hawaii's is the conic between 8 and 18 degrees; its centre is west of Greenwich, whatever sign a table gives it.
BY_REGION = {"CONUS": BY_CODE[5070], "AK": BY_CODE[3338], "HI": Albers(8.0, 18.0, 13.0, -157.0), "PRVI": BY_CODE[32619], "GU": BY_CODE[32655]}


def reprojected(shapes: DataFrame, source, target=None, rings: str = "rings") -> DataFrame:
    """All columns, with rings (points lon, lat; of a projected source these hold x and y) moved from one projection to another; None stands for degrees.

    Points alone are moved: an edge is straight in the target again.
    """

    def moved(p: Column) -> Column:
        place = source.inverse(p["lon"], p["lat"]) if source else F.struct(p["lon"].alias("lon"), p["lat"].alias("lat"))
        if target is None:
            return place
        to = lambda q: F.struct(q["x"].alias("lon"), q["y"].alias("lat"))
        return _let(place, lambda q: _let(target.forward(q["lon"], q["lat"]), to))

    return shapes.withColumn(rings, F.transform(rings, lambda r: F.transform(r, moved)))
